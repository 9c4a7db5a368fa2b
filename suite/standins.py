"""The benchmark tables in the roles of the operators' inputs.

`events` stands in for telemetry, `orders` / `customer` and `lineitem` / `part` for work
orders, meters and assets, `nation` / `region` for code tables. `suite.oracle` holds the same
mappings in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark.plans import telemetry as flat

# What the stand-ins exclude and recode in place of the operators' own lists.
SORT_KEYS = ("NATION_3", "NATION_7")
CUSTOMER_PARTS = ("77", "#0000013")
PART_PARTS = ("anvil", "old ")
PART_MAKES = {
    "small ring": "ring",
    "red ring": "ring",
    "old ring": "ring",
    "small bolt": "bolt",
    "red bolt": "bolt",
    "blue gear": "gear",
    "hot gear": "gear",
}
SEGMENT_MAKES = {"machinery": "machine", "furniture": "household"}


# Schemas of the tables, so that reading one needs no job to look into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Events of one kind as a telemetry table with machine, chassis and type ids."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == kind)
        .select(
            "event_id",
            "ts",
            F.col("user_id").alias("mjid"),
            (F.col("user_id") % 10).alias("chid"),
            "value",
            (F.col("user_id") % 5).alias("latchtypeid"),
            (F.col("user_id") % 25).alias("vehicletypeid"),
        )
    )


# Columns of the flat file's sides beside keys, types and times, and the kind of event of each.
FLAT_SIDES = {
    "view": [
        name for name in flat.POSITION_COLUMNS
        if name not in (*flat.MACHINE, flat.TIME, flat.DATE, "sourcesystemtimestamp", "latchtypeid", "vehicletypeid")
    ],
    "click": [name for name in flat.LATCH_COLUMNS.values() if name != flat.TIME],
    "purchase": [name for name in flat.FUEL_COLUMNS.values() if name != flat.TIME],
    "error": [name for name in flat.IMPACT_COLUMNS.values() if name != flat.TIME],
    "signup": ["pressure", "temperature"],
}


def flat_side(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """A side of the flat file under its own column names, few machines, each measure another number."""
    user = F.col("user_id")
    measures = [(F.col("value") + i).alias(name) for i, name in enumerate(FLAT_SIDES[kind])]
    return table(spark, sf_dir, "events").where(F.col("event_type") == kind).select(
        (user % 3).alias("mjid"), (user % 10).alias("chid"),
        (user % 5).alias("latchtypeid"), (user % 25).alias("vehicletypeid"),
        F.col("ts").alias(flat.TIME), F.col("ts").alias("sourcesystemtimestamp"),
        F.col("ts").cast("date").alias(flat.DATE), *measures,
    )


def code_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the shared code table; two of them name the attributes."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.alias("tableid"),
        F.when(key == 23, "MAKE").when(key == 24, "MODEL NO").otherwise(F.col("n_name")).alias(
            "tablename"
        ),
        (key * 10).cast("string").alias("tablevalue"),
        F.when(key == 4, "NULL").otherwise(F.concat(F.lit("Cause "), "n_name")).alias(
            "tabledescription"
        ),
    )


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("operationalviewid"), F.col("r_name").alias("name")
    )


def customer_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("operationalassetid"),
        F.col("c_name").alias("operationalassetname"),
        F.col("c_mktsegment").alias("operationalassetdescription"),
        F.when(F.col("c_acctbal") >= 0, F.make_date(nation + 1980, F.lit(6), F.lit(15))).alias(
            "installdate"
        ),
        (nation % 5).alias("operationalviewid"),
        nation.alias("sortkeyid"),
    )


def _priority() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("int")


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raised = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("workorderid"),
        F.col("o_custkey").alias("operationalassetid"),
        F.col("o_orderstatus").alias("worktypeid"),
        raised.alias("raisedate"),
        F.when(_priority() < 5, F.date_add(raised, _priority() * 10)).alias("finishdate"),
        _priority().alias("faultid"),
    )


def order_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        status.alias("worktypeid"),
        F.concat(F.lit("Type "), status).alias("name"),
        F.when(status == "F", "Failure").when(status == "O", "Maintenance").otherwise(
            "Inspection"
        ).alias("category"),
    ).distinct()


def customer_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("operationalassetid"),
        read.alias("updatetime"),
        read.alias("createtime"),
        F.col("o_orderpriority").alias("metername"),
        F.when(F.col("o_orderstatus") == "P", "Hour Meter").otherwise("Odometer").alias(
            "meterdescription"
        ),
        (F.col("o_totalprice") / 1000).alias("reading"),
    )


def customer_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("operationalassetid"),
        _priority().alias("tasksynclevel"),
        (F.month("o_orderdate") * 50).alias("frequency"),
    )


def customer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment as make, in blanks; customers of one nation have another attribute instead."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("keyid"),
        F.when(F.col("c_nationkey") == 9, 22).otherwise(23).alias("attributenameid"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("datavalue"),
    )


def part_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("operationalassetid"),
        F.col("p_name").alias("operationalassetname"),
        F.col("p_type").alias("operationalassetdescription"),
        F.make_date(F.col("p_size") % 10 + 1990, F.lit(1), F.lit(31)).alias("installdate"),
        (F.col("p_size") % 5).alias("operationalviewid"),
        (F.expr("substring(p_brand, 7)").cast("int") - 1).alias("sortkeyid"),
    )


def part_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("workorderid"),
        F.col("l_partkey").alias("operationalassetid"),
        F.col("l_returnflag").alias("worktypeid"),
        (F.col("l_linenumber") * 5).alias("faultid"),
    )


def line_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        flag.alias("worktypeid"),
        F.when(flag == "R", "FAIL").when(flag == "A", "SCH").otherwise("OTHER").alias("name"),
        F.when(flag == "R", "Failure").when(flag == "A", "Maintenance").otherwise(
            "Inspection"
        ).alias("category"),
    ).distinct()


def part_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = F.col("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("operationalassetid"),
        read.alias("updatetime"),
        read.alias("createtime"),
        F.col("l_linestatus").alias("metername"),
        F.concat(F.lit("Meter "), "l_returnflag").alias("meterdescription"),
        F.col("l_quantity").alias("reading"),
    )


def part_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make (two rows, the first counts) and model per part, some missing or marked as null."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    make = F.when(size == 50, "NULL").otherwise(F.concat(F.lit(" \t"), F.upper("p_name"), F.lit(" ")))
    values = [
        (F.lit(23), make),
        (F.lit(23), F.concat(F.lit("ZZ "), "p_brand")),
        (F.when(size == 49, 22).otherwise(24), F.col("p_type")),
    ]
    rows = [F.struct(a.alias("attributenameid"), v.alias("datavalue")) for a, v in values]
    return part.select(F.col("p_partkey").alias("keyid"), F.inline(F.array(*rows)))
