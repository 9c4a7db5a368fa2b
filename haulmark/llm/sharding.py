"""Hierarchical weighted hash tree: rows descend region, rack and shard by weighted draws.

Law `key`: a row's key and the tree decide its shard. At every level each child draws
`-ln(u) / weight` with `u` hashed from the key and the child's path, and the smallest draw wins.
A child's draw does not depend on its siblings, so a changed weight moves rows only into or out
of the subtrees whose weights changed. `grow` puts a new shard into a region of its own: no other
weight changes, so rows move only into the new shard. A weight may be changed in place too; then
rows move between the regions and racks above it, and untouched subtrees keep their inner order.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import hash_fraction


@dataclass(frozen=True)
class Leaf:
    """A shard, where it stands, and its share of the rows relative to the others."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """Shards from 0 on, `per_rack` to a rack and `racks` to a region."""
    per_region = per_rack * racks
    return [Leaf(s // per_region, s % per_region // per_rack, s) for s in range(shards)]


def grow(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own."""
    region = max(x.region for x in tree) + 1
    return [*tree, Leaf(region, 0, max(x.shard for x in tree) + 1, weight)]


def _total(leaves: Iterable[Leaf]) -> float:
    return sum(x.weight for x in leaves)


def _nodes(tree: list[Leaf]) -> Column:
    """The tree as a constant: regions with their racks with their shards."""
    regions: dict[int, dict[int, list[Leaf]]] = {}
    for x in sorted(tree, key=lambda x: (x.region, x.rack, x.shard)):
        if not x.weight > 0:
            raise ValueError(f"shard {x.shard} needs a weight above 0")
        regions.setdefault(x.region, {}).setdefault(x.rack, []).append(x)

    def node(path: str, shard: int, weight: float, children: list[Column] | None = None) -> Column:
        fields = [F.lit(path).alias("path"), F.lit(shard).alias("shard"), F.lit(float(weight)).alias("weight")]
        return F.struct(*fields, *([F.array(*children).alias("children")] if children else []))

    return F.array(
        *(
            node(
                f"{r}",
                -1,
                _total(x for rack in racks.values() for x in rack),
                [
                    node(f"{r}/{k}", -1, _total(rack), [node(f"{r}/{k}/{x.shard}", x.shard, x.weight) for x in rack])
                    for k, rack in racks.items()
                ],
            )
            for r, racks in regions.items()
        )
    )


def _drawn(children: Column, key: Column) -> Column:
    draws = F.transform(
        children,
        lambda c: F.struct((-F.log(hash_fraction(key, c["path"])) / c["weight"]).alias("draw"), c.alias("node")),
    )
    return F.array_min(draws)["node"]


def place(key: Column, tree: list[Leaf]) -> Column:
    """Shard of a key; a null key is a key like any other."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    region = _drawn(_nodes(tree), key)
    rack = _drawn(region["children"], key)
    return _drawn(rack["children"], key)["shard"]


def assign_shards(
    docs: DataFrame,
    tree: list[Leaf],
    key: str = "doc_id",
    text: str = "text",
    blocks: int = 4096,
) -> DataFrame:
    """One row per document: key, size, text_crc32, shard and slot.

    `size` is the text's UTF-8 bytes (null: none) plus 16, `slot` the gapless place in the shard.
    Slots follow (block, key, size, checksum), where a hash spreads each shard over `blocks`
    blocks: blocks are counted, their counts summed up per shard, and only the rows of one block
    are ever ranked together. Equal rows are counted before the shuffle and dealt out again, at
    most `RUN` in one row, so they take one place in a block however many they are; among
    them slots are interchangeable. Texts are not shuffled.

    Null texts have size 16 and the checksum of an empty text; a null key is placed like any
    other. An empty table gives no rows. Columns other than key and text are not read.
    """
    slim = docs.select(
        F.col(key).alias("_key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    word = F.concat_ws(":", F.coalesce(F.col("_key").cast("string"), F.lit("null")), F.col("text_crc32").cast("string"))
    block = F.conv(F.substring(F.md5(word), 1, 6), 16, 10).cast("int") % blocks
    rows = slim.groupBy("_key", "size", "text_crc32").agg(F.count("*").alias("_n"))
    rows = rows.select("*", place(F.col("_key"), tree).alias("shard"), block.alias("_block"))

    order = Window.partitionBy("shard").orderBy("_block")
    counts = rows.groupBy("shard", "_block").agg(F.sum("_n").alias("_rows"))
    before = counts.select("shard", "_block", (F.sum("_rows").over(order) - F.col("_rows")).alias("_before"))
    ranked = Window.partitionBy("shard", "_block").orderBy("_key", "size", "text_crc32")
    first = F.col("_before") + F.sum("_n").over(ranked) - F.col("_n")
    placed = rows.join(before, ["shard", "_block"]).withColumn("_first", first)
    return _dealt_out(placed).select(F.col("_key").alias(key), "size", "text_crc32", "shard", "slot")


#: Equal rows that one generated row stands for at most, before it is dealt out.
RUN = 65536


def _dealt_out(placed: DataFrame) -> DataFrame:
    """A row for each of `_n` equal rows, in two steps so that no array exceeds `RUN` numbers."""
    runs = placed.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("_n") - 1), F.lit(RUN).cast("long"))))
    last = F.least(F.col("_run") + RUN, F.col("_n")) - 1
    return runs.withColumn("_copy", F.explode(F.sequence("_run", last))).withColumn("slot", F.col("_first") + F.col("_copy"))


def write_shards(docs: DataFrame, path: str, tree: list[Leaf], key: str = "doc_id", tasks_per_shard: int = 16) -> None:
    """Write documents to a folder per shard, each shard by up to `tasks_per_shard` tasks."""
    spread = F.pmod(F.xxhash64(*docs.columns), F.lit(tasks_per_shard))
    placed = docs.withColumn("shard", place(F.col(key), tree))
    placed.repartition(F.col("shard"), spread).write.partitionBy("shard").parquet(path)
