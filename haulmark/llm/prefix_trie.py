"""Prefix trie of conversations, by burst tries.

A turn's id is the MD5 of role and text. A conversation is a sequence of turn ids; a node of the trie is
a distinct prefix and is named by its smallest member and its depth. Shards hold containers: the
suffixes below one trie head. A container of more than `limit` different suffixes is burst: what its suffixes
share becomes a chain of nodes (the least and the greatest suffix tell how much that is), the end of
the chain a trie head, and each next turn id a container of its own. Containers that are left are sorted and
swept by a stack into nodes; what they add to the heads above them is summed over the paths of heads.

Equal sequences are one suffix with a count, so copies never fill a container. Sequences are cut into
slabs of `reach` turns: first every slab's heads are named going down, then the tries of the slabs are
built going up, the deeper ones handing their sums to the last nodes of those above. A conversation that
shares its slab with no other needs no trie from there on; its turns are nodes as they stand. So no row
holds more than `reach` turns, however long a conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import written
from haulmark.operators.skew import dealt_join

#: Suffixes of a container from which on it is burst. With very many suffixes the limit is this share of them, so that
#: fewer than 1 / SHARE containers are burst at a time and the list of them is safe to broadcast.
LIMIT, SHARE = 20_000, 1e-5

#: Turns of a slab.
REACH = 1024

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end long, many boolean"
_SWEPT = f"box string, path array<string>, head long, {_NODE}"


def numbered_turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, rank, id, size) of every turn: rank from 1 in its conversation, id of role and text, bytes of the text.

    Order: turn (null first), role, text; repeated rows are turns of their own. Null roles and texts are
    empty. Rows without a conversation are left out. Turns are sorted over range partitions and ranked from
    the counts of the partitions, so a conversation with very many turns is spread over many tasks.
    """
    blank = F.lit("")
    rows = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), blank).alias("role"), F.coalesce(F.col(text).cast("string"), blank).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "role", "text", "row"]
    laid_out = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = laid_out.select(
        "conv_id",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))).alias("id"),
        F.octet_length("text").cast("long").alias("size"),
    )
    turns = written(turns, "turns")
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    along = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    rank = F.col("before") + F.col("place") - F.col("first") + 1
    return turns.join(parts.drop("n"), ["conv_id", "part"]).select("conv_id", rank.alias("rank"), "id", "size")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, length) of the conversations in `turns`."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("length"))


def branched(turns: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations of `numbered_turns` rebuilt as branches of others, and their lengths.

    The first `shared` turns of a conversation (at most `most`) become those of the conversation `base`, all
    if it has fewer, none if there is no such conversation.
    """
    convs = lengths(turns).select("conv_id", F.col("length").alias("own"), base.alias("base"), shared.cast("long").alias("shared"))
    convs = written(convs, "conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("_of_base"))
    taken = F.least("shared", F.coalesce("_of_base", F.lit(0))).alias("taken")
    convs = written(convs.join(bases, "base", "left").select("conv_id", "own", "base", "shared", taken), "branches")
    firsts = turns.filter(F.col("rank") <= most).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "size"))).alias("turns"))
    firsts = firsts.withColumnRenamed("conv_id", "base")
    heads = convs.filter("taken > 0").join(firsts, "base").select("conv_id", F.explode(F.slice("turns", 1, F.col("taken").cast("int"))).alias("t"))
    heads = heads.select("conv_id", F.col("t.rank").alias("rank"), "t.id", "t.size")
    # the few numbers of a conversation are needed by each of its turns: dealt out, as one may have very many
    own = dealt_join(turns, convs.select("conv_id", "shared", "taken"), "conv_id").filter(F.col("rank") > F.col("shared"))
    own = own.select("conv_id", (F.col("taken") + F.col("rank") - F.col("shared")).alias("rank"), "id", "size")
    return heads.unionByName(own), convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("shared"), F.lit(0))).alias("length"))


def prefix_trie(turns: DataFrame, convs: DataFrame, limit: int = LIMIT, reach: int = REACH) -> DataFrame:
    """The nodes of the trie over `turns` (conv_id, rank, id, size) of `convs` (conv_id, length).

    Result: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves (childless nodes in the subtree), saved_tokens ((n_convs - 1) times the bytes of the last text,
    summed over the subtree) and ends_sha256 (of the members that end there, ascending, joined by commas).

    `convs` may hold conversations without turns: they end at the root. Without any there is no node.
    The digest of a node where very many conversations end runs through one task in sorted order, as
    a SHA-256 must; it is streamed and needs no memory for them.
    """
    cut = F.floor((F.col("rank") - 1) / reach)
    slabs = turns.groupBy("conv_id", cut.alias("slab")).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "size"))).alias("t"))
    slabs = written(slabs.select("conv_id", "slab", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes")), "slabs")
    convs = written(convs, "lengths")
    first = convs.agg(F.min("conv_id").alias("root"), F.count("*").alias("n")).first()
    if not first["n"]:
        return convs.limit(0).select(*[F.lit(None).cast("long").alias(c) for c in _COLUMNS[:-1]], F.lit("").alias(_COLUMNS[-1]))

    empty = F.array().cast("array<binary>"), F.array().cast("array<bigint>")
    members = convs.join(slabs.filter("slab = 0").drop("slab"), "conv_id", "left").select(
        "conv_id", "length", F.lit(first["root"]).alias("head"), F.coalesce("ids", empty[0]).alias("ids"), F.coalesce("sizes", empty[1]).alias("sizes")
    )
    levels, ends, tails = [], [], []
    while True:
        level = len(levels)
        done = F.col("length") <= (level + 1) * reach
        named = written(members.withColumns({"seq": _name("head", "ids"), "done": done}), "members")
        groups = named.groupBy("seq", "head", "ids", "sizes").agg(
            F.min("conv_id").alias("conv"), F.count("*").alias("n"),
            F.min(F.when(F.col("done"), F.col("conv_id"))).alias("end"), F.count_if("done").alias("n_end"),
        )
        groups = written(groups, "sequences")
        levels.append(groups)
        ends.append(dealt_join(named.filter("done").select("conv_id", "seq"), groups.filter("n_end > 1").select("seq", "end"), "seq").select("end", "conv_id"))
        longer = named.filter(~F.col("done")).select("conv_id", "length", "seq")
        longer = written(dealt_join(longer, groups.filter("n > n_end").select("seq", F.col("conv").alias("head"), "n"), "seq").drop("seq"), "longer")
        rest = slabs.filter(F.col("slab") > level)
        lone = longer.filter("n = 1").select("conv_id", "length")
        tails.append(dealt_join(rest, lone, "conv_id").withColumn("at", F.col("slab") * reach))
        shared = longer.filter("n > 1").select("conv_id", "length", "head")
        if shared.isEmpty():
            break
        members = shared.join(rest.filter(F.col("slab") == level + 1).drop("slab"), "conv_id")

    nodes, carry = [], None
    for level in reversed(range(len(levels))):
        found, carry = _level(levels[level], carry, level, limit, reach)
        nodes.append(found)
    root = carry.select(
        F.col("head").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(first["n"]).cast("long").alias("n_convs"), F.col("in_children").alias("n_children"),
        F.greatest("in_leaves", F.lit(1)).alias("n_leaves"), F.col("in_saved").alias("saved_tokens"), "end", "many",
    )
    tail = reduce(DataFrame.unionByName, tails).select("conv_id", "length", "at", F.posexplode("ids").alias("pos", "id"))
    depth = F.col("at") + F.col("pos") + 1
    last = depth == F.col("length")
    tail = tail.select(
        "conv_id", depth.cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"), F.when(last, F.col("conv_id")).alias("end"), F.lit(False).alias("many"),
    )
    everything = written(reduce(DataFrame.unionByName, [*nodes, root, tail]), "nodes")
    return _with_digests(everything, reduce(DataFrame.unionByName, ends))


_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _name(head: str, ids: str) -> Column:
    """Name of a sequence below a head, 128 bits."""
    return F.md5(F.concat_ws("/", F.col(head).cast("string"), F.transform(ids, lambda x: F.hex(x))).cast("binary"))


def _with_digests(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """`nodes` with the digest of the members that end there; `ends` has those of nodes where several do."""
    streamed = ends.repartition("end").sortWithinPartitions("end", "conv_id").mapInArrow(_digest, "end long, ends_sha256 string")
    several = nodes.filter("many").join(streamed, "end").select(*_COLUMNS)
    one = F.sha2(F.coalesce(F.col("end").cast("string"), F.lit("")).cast("binary"), 256).alias("ends_sha256")
    return nodes.filter("not many").select(*_COLUMNS[:-1], one).unionByName(several)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each run of equal `end` over the sorted batches of a task."""
    end, digest = None, None

    def row():
        return pa.RecordBatch.from_pydict({"end": pa.array([end], pa.int64()), "ends_sha256": [digest.hexdigest()]})

    for batch in batches:
        for key, conv in zip(batch["end"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
            if digest is None or key != end:
                if digest is not None:
                    yield row()
                end, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
    if digest is not None:
        yield row()


def _level(groups: DataFrame, deeper: DataFrame | None, level: int, limit: int, reach: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of the tries over one slab's sequences, and what they add to their heads.

    `deeper` is that of the next slab: (head, in_children, in_leaves, in_saved). A sequence that one
    conversation goes beyond alone has one child and one leaf below.
    """
    lone = F.when(F.col("n") == 1, 1 - F.col("n_end")).otherwise(0).cast("long")
    rows = groups.withColumns({"in_children": lone, "in_leaves": lone, "in_saved": F.lit(0).cast("long")})
    if deeper is not None:
        below = deeper.select(F.col("head").alias("conv"), *[F.col(c).alias(f"_{c}") for c in _SUMS])
        rows = rows.join(below, "conv", "left").withColumns({c: F.coalesce(f"_{c}", c) for c in _SUMS}).drop(*[f"_{c}" for c in _SUMS])
    rows = rows.select(
        F.col("head").cast("string").alias("box"), F.lit(0).alias("at"), "head", F.array().cast("array<string>").alias("path"), F.col("head").alias("up"),
        "ids", "sizes", "conv", "n", "end", (F.col("n_end") > 1).alias("many"), *_SUMS,
    )
    rows = written(rows, "suffixes")
    few, burst, tops = [], [], []
    bound = max(limit, int(SHARE * rows.count()))
    while True:
        boxes = rows.groupBy("box").agg(F.count("*").alias("_n")).filter(F.col("_n") > bound).select("box")
        boxes = written(boxes, "boxes")
        if boxes.isEmpty():
            few.append(rows)
            break
        few.append(rows.join(F.broadcast(boxes), "box", "left_anti"))
        large = rows.join(F.broadcast(boxes), "box")
        heads = large.groupBy("box", "at", "head", "path", "up").agg(
            F.min("ids").alias("_lo"), F.max("ids").alias("_hi"), F.min("sizes").alias("sizes"), F.sum("n").alias("n"), F.min("conv").alias("conv")
        )
        shared = F.array_position(F.zip_with("_lo", "_hi", lambda a, b: F.coalesce(a == b, F.lit(False))), False)
        heads = heads.withColumn("to", F.when(shared > 0, shared - 1).otherwise(F.size("_lo")).cast("int"))
        heads = heads.withColumns({"conv": F.when(F.col("to") == F.col("at"), F.col("up")).otherwise(F.col("conv")), "sizes": F.slice("sizes", F.col("at") + 1, F.col("to") - F.col("at"))})
        heads = written(heads.drop("_lo", "_hi"), "heads")
        burst.append(heads)
        below = large.drop("at", "up").join(F.broadcast(heads.select("box", F.col("to").alias("at"), F.col("conv").alias("up"))), "box")
        tops.append(below.filter(F.size("ids") == F.col("at")).select("box", "end", "many", *_SUMS))
        down = below.filter(F.size("ids") > F.col("at"))
        inner = F.md5(F.concat_ws("/", "box", F.hex(F.get("ids", F.col("at")))).cast("binary"))
        rows = written(down.withColumns({"path": F.concat("path", F.array("box")), "box": inner}).select(rows.columns), "suffixes")
    shards = reduce(DataFrame.unionByName, few).repartition("box").sortWithinPartitions("box", "ids")
    swept = written(shards.mapInArrow(_sweeper(level * reach), _SWEPT), "swept")
    nodes = swept.filter("depth is not null").select(*_NODE_COLUMNS)
    sums = swept.filter("depth is null").select(
        "box", "path", "head", "end", "many", F.col("n_children").alias("in_children"), F.col("n_leaves").alias("in_leaves"), F.col("saved_tokens").alias("in_saved")
    )
    carry = sums.filter(F.size("path") == 0).drop("box", "path")
    if burst:
        more, heads = _burst_nodes(reduce(DataFrame.unionByName, burst), reduce(DataFrame.unionByName, tops), sums, level * reach)
        nodes, carry = nodes.unionByName(more), carry.unionByName(heads)
    return nodes, written(carry, "sums")


_SUMS = ["in_children", "in_leaves", "in_saved"]
_NODE_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]


def _burst_nodes(burst: DataFrame, tops: DataFrame, sums: DataFrame, offset: int) -> tuple[DataFrame, DataFrame]:
    """The chains of nodes that end in burst heads, and what those at the top of the slab add to their heads."""
    weight = F.col("n") - 1
    burst = burst.join(tops, "box", "left").fillna(0, _SUMS).withColumn("many", F.coalesce("many", F.lit(False)))
    burst = burst.withColumn("chain", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x) * weight)
    burst = written(burst, "burst")
    one = F.lit(1).cast("long")
    # a container adds to every head above it; to the one right above, a child
    inner = sums.filter(F.size("path") > 0).select("path", "in_leaves", "in_saved").unionByName(
        burst.select("path", "in_leaves", (F.col("in_saved") + F.col("chain")).alias("in_saved"))
    )
    above = inner.select(F.posexplode("path").alias("i", "box"), (F.size("path") - 1).alias("last"), "in_leaves", "in_saved")
    above = above.groupBy("box").agg(
        F.sum("in_leaves").alias("_leaves"), F.sum("in_saved").alias("_saved"), F.sum(F.when(F.col("i") == F.col("last"), one).otherwise(0)).alias("_children")
    )
    met = burst.join(above, "box").select(
        "head", "at", "to", "up", "conv", "n", "sizes", "end", "many", "path", "chain",
        (F.col("in_children") + F.col("_children")).alias("children"), (F.col("in_leaves") + F.col("_leaves")).alias("leaves"), (F.col("in_saved") + F.col("_saved")).alias("saved"),
    )
    met = written(met, "burst_heads")
    links = met.filter(F.col("to") > F.col("at")).select("*", F.posexplode("sizes").alias("i", "_size"))
    last = F.col("at") + F.col("i") + 1 == F.col("to")
    rest = F.aggregate(F.slice("sizes", F.col("i") + 1, F.size("sizes")), F.lit(0).cast("long"), lambda a, x: a + x) * weight
    nodes = links.select(
        F.col("conv").alias("conv_id"), (F.lit(offset) + F.col("at") + F.col("i") + 1).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(one).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") + rest).alias("saved_tokens"), F.when(last, F.col("end")).alias("end"), (last & F.col("many")).alias("many"),
    )
    start = F.col("to") == F.col("at")
    carry = met.filter(F.size("path") == 0).select(
        "head", F.when(start, F.col("end")).alias("end"), (start & F.col("many")).alias("many"),
        F.when(start, F.col("children")).otherwise(one).alias("in_children"), F.col("leaves").alias("in_leaves"), (F.col("saved") + F.col("chain")).alias("in_saved"),
    )
    return nodes, carry


class _Open:
    """An open node of the sweep; `done` are the records of its children, which wait for its smallest member."""

    __slots__ = ("children", "conv", "done", "end", "leaves", "many", "n", "saved", "size")

    def __init__(self, size: int):
        self.n = self.children = self.leaves = self.saved = 0
        self.conv, self.end, self.many, self.size, self.done = None, None, False, size, []

    def take(self, n: int, conv: int, children: int, leaves: int, saved: int) -> None:
        self.n += n
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.children += children
        self.leaves += leaves
        self.saved += saved


def _sweeper(offset: int):
    """A task that sweeps sorted containers into records of nodes, and one more per container of what it adds to its head."""
    schema = pa.schema(
        [("box", pa.string()), ("path", pa.list_(pa.string())), ("head", pa.int64())]
        + [(c, pa.bool_() if c == "many" else pa.int64()) for c in _NODE_COLUMNS]
    )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        box, stack, before = None, [], []
        at = head = up = path = None

        def close(depth: int) -> None:
            """Closes the nodes deeper than `depth` below the head."""
            while len(stack) - 1 > depth:
                node = stack.pop()
                parent = stack[-1]
                place = offset + at + len(stack)
                leaves = node.leaves if node.children else 1
                saved = node.saved + (node.n - 1) * node.size
                out.extend((*r[:5], node.conv, *r[6:]) for r in node.done)
                parent.take(node.n, node.conv, 1, leaves, saved)
                parent.done.append((None, None, None, node.conv, place, None, node.n, node.children, leaves, saved, node.end, node.many))

        def finish() -> None:
            close(0)
            top = stack[0]
            out.extend((*r[:5], up, *r[6:]) for r in top.done)
            out.append((box, path, head, None, None, None, top.n, top.children, top.leaves, top.saved, top.end, top.many))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = row["ids"], row["sizes"]
                if row["box"] != box:
                    if stack:
                        finish()
                    box, at, head, up, path = row["box"], row["at"], row["head"], row["up"], row["path"]
                    stack, before = [_Open(0)], []
                same = at
                while same < len(before) and same < len(ids) and before[same] == ids[same]:
                    same += 1
                close(same - at)
                stack.extend(_Open(size) for size in sizes[same:])
                node = stack[-1]
                node.take(row["n"], row["conv"], row["in_children"], row["in_leaves"], row["in_saved"])
                node.end, node.many, before = row["end"], row["many"], ids
                if len(out) > 10_000:
                    yield flush()
        if stack:
            finish()
        if out:
            yield flush()

    return sweep
