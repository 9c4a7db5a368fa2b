"""Helpers shared by the operators: written intermediate tables and small column expressions."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word ends at a blank or a control character from tab to return.
WORD = "[^ \\t-\\r]+"


#: Folders of local sessions that name none, by application.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share, from `spark.checkpoint.dir`.

    Unset, a local session gets a temporary folder; on a cluster this is an error, since no
    folder of one machine would do.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(context.applicationId)
    if not folder:
        if re.fullmatch(r"local(\[.*\])?", context.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = _OWN[context.applicationId] = tempfile.mkdtemp(prefix="haulmark-")
    return f"{folder.rstrip('/')}/haulmark-{context.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of what came before, and a frame
    that is used twice is evaluated once. All tables of an application lie in one folder, which
    may go when the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """`rows` with `rank`, from 1 within the rows of a `key` (null is one) by `order`; equal rows get ranks of their own.

    Rows are sorted over range partitions and ranked from the partitions' counts, so a key with very many
    rows is spread over many tasks.
    """
    names = [key, *order, "_row"]
    sorted_rows = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*names).sortWithinPartitions(*names)
    kept = sorted_rows.select(*rows.columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
    kept = written(kept, "sorted")
    along = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    parts = kept.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_of")).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(along), F.lit(0)))
    met = kept.join(parts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")))
    return met.select(*rows.columns, (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias("rank"))


def first_by_hash(rows: DataFrame, n: int, order: Column) -> DataFrame:
    """At most `n` rows, those with the smallest hash `order` (a long), of rows with equal hashes one.

    A threshold from the number of different hashes leaves little more than `n` rows to sort, so what the
    tasks send to the driver does not grow with their number. `rows` is evaluated twice.
    """
    hashed = rows.withColumn("_order", order)
    different = hashed.agg(F.approx_count_distinct("_order", 0.02)).first()[0]
    share = (1.2 * n + 200) / max(different, 1)
    if share < 1:
        hashed = hashed.filter(F.col("_order") < F.lit(int(share * 2**64) - 2**63))
    return hashed.dropDuplicates(["_order"]).orderBy("_order").limit(n).drop("_order")


def hash_fraction(*parts: Column) -> Column:
    """A draw from the open interval 0 to 1, fixed by the strings of `parts` (52 bits of their MD5)."""
    digits = F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)
