"""Groups too large for one task, and a join that splits them.

Spark's adaptive execution splits a large group only where both sides of a join come
straight from a shuffle. The join here does not depend on that: it looks the large groups up
first and cuts them into parts of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SPLITS, HASH, PART, SIDE = "_splits", "_hash", "_part", "_side"

# A group is split when it holds more rows than this, which one task handles with ease, whatever
# the table holds. The share only bounds the list of such groups on its way over the driver.
SHARE = 1e-5
MIN_ROWS = 1_000_000

# Rows and bytes up to which a lookup table is broadcast once they are measured.
MOST_BROADCAST = 100_000
MOST_BYTES = 32_000_000

# Bytes of a row at least, in Spark's estimate of a table from its files.
LEAST_ROW = 8

# Parts of a key in `dealt_join`.
PARTS = 16

# Copies that one generated row stands for at most.
RUN = 10_000


def heavy_groups(
    df: DataFrame,
    keys: Sequence[str],
    within: str,
    share: float = SHARE,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Groups of `keys` with more than `min_rows` rows, and the parts to cut them into.

    Only where `share` of the rows of their `within` is more than that, the limit is this: a
    value of `within` has at most `1 / share` such groups whatever the data holds, so the
    result is small enough for the driver and for a broadcast. Rows are counted per task
    before the shuffle.
    """
    sizes = df.groupBy(within, *keys).agg(F.count(F.lit(1)).alias("_rows"))
    totals = sizes.groupBy(within).agg(F.sum("_rows").alias("_total"))
    limit = F.greatest(F.col("_total") * F.lit(share), F.lit(float(min_rows)))
    return (
        sizes.where(F.col("_rows") > min_rows)
        .join(totals, within)
        .where(F.col("_rows") > limit)
        .select(within, *keys, F.ceil(F.col("_rows") / limit).cast("int").alias(SPLITS))
    )


def heavy_hashes(
    sides: Sequence[DataFrame], share: float = SHARE, min_rows: int = MIN_ROWS
) -> list[dict[int, int]]:
    """Per side, a DataFrame of one hash column, its heavy hashes and the parts of each.

    One job for all sides. At most `1 / share` hashes per side reach the driver, usually none.
    """
    tagged = [
        hashes.select(F.lit(side).alias(SIDE), "*").toDF(SIDE, HASH)
        for side, hashes in enumerate(sides)
    ]
    found: list[dict[int, int]] = [{} for _ in sides]
    union = reduce(DataFrame.unionAll, tagged)
    for row in heavy_groups(union, [HASH], SIDE, share, min_rows).collect():
        found[row[SIDE]][row[HASH]] = row[SPLITS]
    return found


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.MapType)


def row_hash(df: DataFrame) -> Column:
    """Hash that differs between rows, and between copies of a row read by different tasks.

    It depends on the row and the number of its partition only, so a repeated task deals its
    rows out as before. Maps have no hash and are left out; of a struct with maps the other fields count.
    """
    hashed: list[Column] = []
    for field in df.schema:
        if not _holds_map(field.dataType):
            hashed.append(F.col(field.name))
        elif isinstance(field.dataType, T.StructType):
            inner = [part.name for part in field.dataType if not _holds_map(part.dataType)]
            hashed += [F.col(field.name)[name] for name in inner]
    return F.xxhash64(*hashed, F.spark_partition_id())


def heavy_keys(
    tables: Sequence[tuple[DataFrame, str]], share: float = SHARE, min_rows: int = MIN_ROWS
) -> list[dict[int, int]]:
    """`heavy_hashes` of one key column per table."""
    return heavy_hashes([df.select(F.xxhash64(key)) for df, key in tables], share, min_rows)


def split_join(
    facts: DataFrame,
    other: DataFrame,
    key: str | Sequence[str],
    heavy: dict[int, int],
    how: str = "inner",
) -> DataFrame:
    """Inner, left or right join on `key`, the heavy keys of `facts` dealt out over several tasks.

    `heavy` comes from `heavy_keys`. Rows of `facts` with a heavy key get one of its parts,
    matching rows of `other` are copied to each, and rows without a key are dealt out too.

    In a right join a row of `other` may meet nothing in one part and something in another. A heavy key has
    facts, having been counted, so copies of it that meet nothing are no unmatched rows and go.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if how == "right":
        facts = facts.where(reduce(Column.__and__, [F.col(name).isNotNull() for name in keys]))
    if not heavy:
        return facts.join(other, keys, how)
    parts = facts.sparkSession.createDataFrame(
        list(heavy.items()), f"{HASH} bigint, {SPLITS} int"
    )
    splits = F.coalesce(F.col(SPLITS), F.lit(1))

    def with_parts(df: DataFrame) -> DataFrame:
        return df.withColumn(HASH, F.xxhash64(*keys)).join(F.broadcast(parts), HASH, "left")

    dealt = with_parts(facts).select(
        *facts.columns, F.pmod(row_hash(facts), splits).cast("int").alias(PART)
    )
    copied = with_parts(other).select(
        *other.columns, splits.alias(SPLITS), F.explode(F.sequence(F.lit(0), splits - 1)).alias(PART)
    )
    if how != "right":
        return dealt.join(copied.drop(SPLITS), [*keys, PART], how).drop(PART)
    joined = dealt.withColumn(SIDE, F.lit(True)).join(copied, [*keys, PART], how)
    return joined.where(F.col(SIDE).isNotNull() | (F.col(SPLITS) == 1)).drop(PART, SIDE, SPLITS)


def dealt_join(
    facts: DataFrame, other: DataFrame, key: str, how: str = "inner", parts: int = PARTS
) -> DataFrame:
    """Inner, left, semi or anti join with a table of few rows per key, every key of `facts` dealt out over `parts`.

    A part holds all of `other` that its facts may meet, so a semi or anti join (`left_semi`, `left_anti`) decides
    each row of `facts` in its part; of `other` the keys are taken once then.

    Nothing is counted: `other` is copied to all parts, which is cheap where it is a small
    share of `facts`. Spark still broadcasts it where its own size check allows that for all copies.
    """
    numbers = F.array(*[F.lit(part) for part in range(parts)])
    dealt = facts.withColumn(PART, F.pmod(row_hash(facts), F.lit(parts)).cast("int"))
    if how in ("left_semi", "left_anti"):
        other = other.select(key).distinct()
    copied = other.withColumn(PART, F.explode(numbers))
    if not may_broadcast(other, parts):
        copied = copied.hint("merge")
    return dealt.join(copied, [key, PART], how).drop(PART)


def estimated_bytes(table: DataFrame) -> int:
    """Spark's estimate of the size of a table, from its files."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def may_broadcast(table: DataFrame, copies: int) -> bool:
    """Whether Spark's size check lets so many copies of each row be broadcast.

    Its own estimate of an exploded table is that of the rows before, so it would broadcast `copies` times its limit.
    """
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(table) * copies <= limit


def may_hold_heavy(table: DataFrame, min_rows: int = MIN_ROWS) -> bool:
    """Whether the table may hold a heavy group at all, by Spark's estimate of its size from the files.

    It spares small tables the counting job. Nothing but speed rests on the estimate: a group it
    overlooks is joined as one, or split by adaptive execution.
    """
    return estimated_bytes(table) >= min_rows * LEAST_ROW


def heavy_among(df: DataFrame, key: str, base: DataFrame) -> dict[int, int]:
    """`heavy_keys` of `df`, which holds rows of `base`; not counted where `base` is small."""
    return heavy_keys([(df, key)])[0] if may_hold_heavy(base) else {}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values, nested ones as their JSON; a fixed amount for each column besides."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(df[field.name])
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = F.octet_length(F.to_json(F.struct(df[field.name])))
        else:
            size = F.lit(0)
        return F.coalesce(size, F.lit(0)).cast("bigint") + 16

    return reduce(Column.__add__, [width(field) for field in df.schema], F.lit(0).cast("bigint"))


def small_table(df: DataFrame, most: int = MOST_BROADCAST, most_bytes: int = MOST_BYTES) -> DataFrame | None:
    """`df` as a table of the rows read, or None if it has more than `most` rows or `most_bytes` bytes.

    At most `most` rows and one are read, in one task, and of these no more than `most_bytes` bytes come
    to the driver, so neither many rows nor wide ones can fill it. The plan of `df` is run
    once; a join then uses the rows that were read.
    """
    order = Window.orderBy("_place")
    read = df.limit(most + 1).select(*df.columns, row_bytes(df).alias("_bytes"), F.monotonically_increasing_id().alias("_place"))
    measured = read.select(
        *df.columns,
        F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_so_far"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_rows"),
    )
    table = measured.where((F.col("_so_far") <= most_bytes) & (F.col("_rows") <= most)).drop("_so_far").toArrow()
    if not table.num_rows:
        return df.limit(0) if df.isEmpty() else None
    if table["_rows"][0].as_py() != table.num_rows:
        return None
    return df.sparkSession.createDataFrame(table.drop_columns(["_rows"]), schema=df.schema)


def lookup_join(
    facts: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    most: int = MOST_BROADCAST,
    share: float = SHARE,
    min_rows: int = MIN_ROWS,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Inner or left join of facts with a lookup table, whose few keys would gather them in few tasks.

    The table is read by `small_table`: up to `most` rows and `most_bytes` bytes it is broadcast and
    `facts` are neither shuffled nor counted. A larger one is joined by `split_join`.
    """
    table = small_table(other, most, most_bytes)
    if table is not None:
        measured = f"_measured_{key}"
        table = F.broadcast(table.withColumnRenamed(key, measured))
        return facts.join(table, F.col(key) == F.col(measured), how).drop(measured)
    [heavy] = heavy_keys([(facts, key)], share, min_rows) if may_hold_heavy(facts, min_rows) else [{}]
    return split_join(facts, other, key, heavy, how)


def repeated(df: DataFrame, copies: str) -> DataFrame:
    """Every row as often as `copies` says, in two steps so that no row holds an array of all of them."""
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, F.lit(RUN).cast("bigint")))
    last = F.least(F.col("_first") + RUN, F.col(copies)) - 1
    runs = df.where(F.col(copies) > 0).withColumn("_first", first)
    return runs.withColumn("_copy", F.explode(F.sequence("_first", last))).drop("_first", "_copy", copies)
