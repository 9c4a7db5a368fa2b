"""Exact top-k by inner product as a Voronoi join.

Pivots cut the space into cells; queries and data are grouped by their nearest pivot. The summary of a
data group is its number of vectors, its radius and the members with the largest inner product with the
pivot; each query's k-th best score among all these members is a lower bound of its k-th best of all. Queries
of a cell lie within a radius of its pivot, so their scores with a whole data group, and with each vector x of
it (`pivot . x + radius * |x|`), have upper bounds. Groups and vectors below the smallest lower bound of the
cell stay away from it. Cells of few queries share a block of queries, so a vector that several of them
need is sent once. Blocks of queries and data, both of bounded size, are solved locally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import first_by_hash, written

#: Numbers of a block of vectors, and queries of a block; they bound a task's memory.
BLOCK_NUMBERS = 4_000_000
BLOCK_QUERIES = 8192
#: What a block is known by.
BLOCK = ("pack", "part", "d")


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or a number that is not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; what a short vector lacks is zero."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integer rows as floats where their inner products are exact in these, else as objects."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    kind = float if most < 2**53 else object
    return a.astype(kind), b.astype(kind)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows from `_exact`."""
    return (a @ b.T).astype(np.int64)


def _pivots(sample: np.ndarray, cells: int, rounds: int = 10) -> np.ndarray:
    """Centres of the sample by Lloyd's algorithm, started from its first rows."""
    centres = np.unique(sample[:cells], axis=0).astype(float)
    for _ in range(rounds):
        nearest = _nearest(sample.astype(float), centres)
        for c in range(len(centres)):
            if (nearest == c).any():
                centres[c] = sample[nearest == c].mean(0)
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def collapsed(rows: DataFrame, k: int) -> DataFrame:
    """Different vectors `v` with `ids`: the k + 1 smallest keys that hold one, each with its number of rows up to k.

    More can not be among the k best of any query, its own key left out.
    """
    counted = rows.groupBy("v", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    counted = counted.withColumn("place", place).filter(F.col("place") <= k + 1)
    return counted.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids"))


def _slack(bound: np.ndarray) -> np.ndarray:
    """Room for rounding."""
    return 1e-9 * (np.abs(bound) + 1) + 1e-6


def _lookup(values: dict[int, Column], by: str) -> Column:
    """Value of a map that has an entry for each cell at most."""
    return F.create_map(*(x for c, v in values.items() for x in (F.lit(c), v)))[F.col(by)]


def _packs(sizes: dict[int, int]) -> tuple[dict[int, int], list[int]]:
    """Pack of each cell and number of parts of each pack: a large cell has its own, small ones share."""
    pack: dict[int, int] = {}
    parts: list[int] = []
    room = 0
    for cell, n in sorted(sizes.items(), key=lambda x: (x[1], x[0])):
        if n > room:
            parts.append(-(-n // BLOCK_QUERIES))
            room = BLOCK_QUERIES if n <= BLOCK_QUERIES else 0
        pack[cell] = len(parts) - 1
        room = max(room - n, 0)
    return pack, parts


def dealt(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "vector",
    cells: int = 16,
    sample: int = 2048,
    members: int = 32,
) -> tuple[DataFrame, DataFrame, int] | None:
    """Queries and data dealt to the blocks (pack, part, d) where they meet, and the largest width; None without queries.

    Queries: ask (a number of its own), id, v, cell. Data: v, ids (see `collapsed`), cells (those that need it).
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v"), is_query.alias("asks"))
    rows = written(rows.filter("id is not null and v is not null"), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return None
    data = written(collapsed(rows, k), "data")
    pivots = _pivots(_matrix(first_by_hash(data.select("v"), sample, F.xxhash64("v")).toPandas()["v"], width), cells)

    def summarised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, radius = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
        best: list[list[tuple[float, int, np.ndarray]]] = [[] for _ in pivots]
        for batch in batches:
            found, ids = _matrix(batch["v"], width), np.array([x[0]["id"] for x in batch["ids"]], np.int64)
            cell = _nearest(found.astype(float), pivots)
            n += np.bincount(cell, minlength=len(pivots))
            np.maximum.at(radius, cell, np.sqrt(((found - pivots[cell]) ** 2).sum(1)))
            along = (found * pivots[cell]).sum(1)
            order = np.lexsort((ids, -along, cell))
            rank = np.arange(len(order)) - np.searchsorted(cell[order], cell[order])
            for i in order[rank < members]:
                best[cell[i]].append((-along[i], ids[i], found[i]))
            best = [sorted(b, key=lambda x: x[:2])[:members] for b in best]
        for c in np.flatnonzero(n):
            names = ("along", "id", "v")
            listed = [dict(zip(names, (-a, i, v.tolist()), strict=True)) for a, i, v in best[c]]
            yield pd.DataFrame({"cell": [c], "n": [n[c]], "radius": [radius[c]], "best": [listed]})

    member = "array<struct<along:double,id:bigint,v:array<bigint>>>"
    summary = written(data.mapInPandas(summarised, f"cell int, n bigint, radius double, best {member}"), "summary")
    held = summary.groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()
    foremost = Window.partitionBy("cell").orderBy(F.desc("along"), "id", "v")
    known = summary.select("cell", F.inline("best")).withColumn("place", F.row_number().over(foremost))
    known = known.filter(F.col("place") <= members).select("id", "v").toPandas()
    known_ids, known = known["id"].to_numpy(), _matrix(known["v"], width)

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = _matrix(batch["v"], width)
            cell = _nearest(asked.astype(float), pivots)
            scores = _scores(*_exact(asked, known)).astype(float)
            scores[batch["id"].to_numpy()[:, None] == known_ids] = -np.inf
            floor = np.sort(scores, 1)[:, -k] if scores.shape[1] >= k else np.full(len(asked), -np.inf)
            radius = np.sqrt(((asked - pivots[cell]) ** 2).sum(1))
            yield pd.DataFrame({"id": batch["id"], "v": batch["v"], "cell": cell, "floor": floor, "radius": radius})

    queries = rows.filter("asks").select("id", "v").distinct()
    queries = queries.mapInPandas(bounded, "id bigint, v array<bigint>, cell int, floor double, radius double")
    queries = written(queries.withColumn("ask", F.monotonically_increasing_id()), "queries")
    groups = queries.groupBy("cell").agg(F.min("floor").alias("floor"), F.max("radius").alias("radius"), F.count("*").alias("n"))
    groups = sorted(groups.collect(), key=lambda g: g["cell"])
    if not groups:
        return None
    asked = np.array([g["cell"] for g in groups])
    floors, radii = (np.array([g[c] for g in groups]) for c in ("floor", "radius"))
    pack, pack_parts = _packs({g["cell"]: g["n"] for g in groups})
    in_pack = np.array([[pack[c] == p for p in range(len(pack_parts))] for c in asked.tolist()])

    reached, filled = np.zeros(len(pivots)), np.zeros(len(pivots), bool)
    filled[[h["cell"] for h in held]] = True
    reached[filled.nonzero()] = [h["radius"] for h in sorted(held, key=lambda h: h["cell"])]
    far = np.sqrt((pivots**2).sum(1))
    most = pivots[asked] @ pivots.T + far[asked, None] * reached + radii[:, None] * far + radii[:, None] * reached
    meets = filled & (most + _slack(most) >= floors[:, None])
    first: dict[int, int] = {}
    data_parts: dict[int, int] = {}
    for h in sorted(held, key=lambda h: h["cell"]):
        first[h["cell"]] = sum(data_parts.values())
        data_parts[h["cell"]] = -(-h["n"] * max(width, 1) // BLOCK_NUMBERS)

    def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _matrix(batch["v"], width).astype(float)
            group = _nearest(found, pivots)
            reach = found @ pivots[asked].T + np.sqrt((found**2).sum(1))[:, None] * radii
            goes = meets[:, group].T & (reach + _slack(reach) >= floors)
            packs = goes @ in_pack
            lists = {"group": group, "cells": [asked[g].tolist() for g in goes], "packs": [np.flatnonzero(p).tolist() for p in packs]}
            yield pd.DataFrame({"v": batch["v"], "ids": batch["ids"], **lists})

    schema = "v array<bigint>, ids array<struct<id:bigint,n:int>>, group int, cells array<int>, packs array<int>"
    data = data.mapInPandas(needed, schema)
    parts_of_pack = {p: F.lit(n) for p, n in enumerate(pack_parts)}
    parts_of_group = {c: F.lit(n) for c, n in data_parts.items()}
    first_of_group = {c: F.lit(n) for c, n in first.items()}
    data = data.withColumn("d", _lookup(first_of_group, "group") + F.pmod(F.xxhash64("v"), _lookup(parts_of_group, "group")))
    data = data.withColumn("pack", F.explode("packs"))
    data = data.withColumn("part", F.explode(F.sequence(F.lit(0), _lookup(parts_of_pack, "pack") - 1)))
    asks = queries.withColumn("pack", _lookup({c: F.lit(p) for c, p in pack.items()}, "cell"))
    asks = asks.withColumn("part", F.pmod(F.xxhash64("ask"), _lookup(parts_of_pack, "pack")).cast("int"))
    met = {c: F.array(*map(F.lit, np.flatnonzero(m).tolist())).cast("array<int>") for c, m in zip(asked.tolist(), meets, strict=True)}
    asks = asks.withColumn("group", F.explode(_lookup(met, "cell")))
    last = _lookup(first_of_group, "group") + _lookup(parts_of_group, "group") - 1
    asks = asks.withColumn("d", F.explode(F.sequence(_lookup(first_of_group, "group").cast("bigint"), last.cast("bigint"))))
    return asks.select(*BLOCK, "ask", "id", "v", "cell"), data.select(*BLOCK, "v", "ids", "cells"), width


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "vector",
    cells: int = 16,
    sample: int = 2048,
    members: int = 32,
) -> DataFrame:
    """The `k` rows with the largest inner product with each row of `is_query`, itself left out.

    `vectors`: key (integer) and vector (array of integers, no nulls). Result: query_id, rank
    from 1, vec_id, score; ties go to smaller keys, fewer rows if there are fewer candidates. Of
    vectors of different length the shorter one counts as zero where it ends. Rows with the query's
    key are the query's own. A query row that repeats is answered once; data rows that repeat count each, and are
    compared once (`collapsed`). Null keys and vectors take no part; other columns, of any name, neither; an empty
    table gives no rows. Scores must fit a long.

    Pivots come from `sample` different vectors, the first by hash. To the driver go that sample, and per cell
    the `members` and a few numbers. Blocks: `BLOCK_QUERIES` queries meet
    `BLOCK_NUMBERS` numbers of data in one task, so a cell with a third of all rows is many tasks.
    """
    blocks = dealt(vectors, is_query, k, key, vector, cells, sample, members)
    if blocks is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    asks, data, width = blocks

    def solved(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        for cell, queries in left.groupby("cell") if len(right) else ():
            needs = np.flatnonzero([(c == cell).any() for c in right["cells"]])
            if not len(needs):
                continue
            asked, against = _exact(_matrix(queries["v"], width), _matrix(right["v"].iloc[needs], width))
            held = [(i, x["id"]) for i, xs in enumerate(right["ids"].iloc[needs]) for x in xs for _ in range(x["n"])]
            place, ids = np.array(held, np.int64).T
            for at in range(0, len(queries), 64):
                block = queries.iloc[at : at + 64]
                for ask, own, scores in zip(block["ask"], block["id"], _scores(asked[at : at + 64], against), strict=True):
                    others = np.flatnonzero(ids != own)
                    best = others[_best(scores[place[others]], ids[others], k)]
                    out += [(ask, own, int(ids[b]), int(scores[place[b]])) for b in best]
        return pd.DataFrame(out, columns=["ask", "query_id", "vec_id", "score"])

    found = asks.groupBy(*BLOCK).cogroup(data.groupBy(*BLOCK)).applyInPandas(solved, "ask bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
