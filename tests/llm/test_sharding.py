from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from haulmark.llm import sharding
from haulmark.llm.queries import ORACLE, op10_hash_tree
from oracle_check import connect, differences


def _draw(key, path):
    return (int(hashlib.md5(f"{key}/{path}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def _place(key, tree):
    path, left = [], tree
    for level in ("region", "rack", "shard"):
        weights = defaultdict(float)
        for x in left:
            weights[getattr(x, level)] += x.weight
        best = min(weights, key=lambda c: -math.log(_draw(key, "/".join(map(str, [*path, c])))) / weights[c])
        path.append(best)
        left = [x for x in left if getattr(x, level) == best]
    return path[-1]


def _gapless(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op10_hash_tree(spark, sf).collect()
    tree = sharding.even_tree(40)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "key")
        assert (r["shard"], r["grown_shard"]) == (_place(r["doc_id"], tree), _place(r["doc_id"], sharding.grow(tree)))
    assert _gapless(rows)


def test_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    with connect(sf) as connection:
        assert differences(op10_hash_tree(spark, sf), connection, ORACLE["op10_hash_tree"]) == []


def test_growth_moves_rows_only_into_the_new_shard(spark):
    tree = sharding.even_tree(6)
    for _ in range(3):
        grown = sharding.grow(tree, weight=2.0)
        rows = spark.range(5000).select(sharding.place(F.col("id"), tree).alias("a"), sharding.place(F.col("id"), grown).alias("b")).collect()
        new = grown[-1].shard
        assert {r["b"] for r in rows if r["a"] != r["b"]} == {new}
        share = sum(r["b"] == new for r in rows) / 5000
        assert abs(share - 2 / sum(x.weight for x in grown)) < 0.03
        tree = grown


def test_a_changed_weight_moves_nothing_inside_other_subtrees(spark):
    tree = sharding.even_tree(24)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 0 else x.weight) for x in tree]
    rows = spark.range(5000).select(sharding.place(F.col("id"), tree).alias("a"), sharding.place(F.col("id"), heavier).alias("b")).collect()
    region = {x.shard: x.region for x in tree}
    moved = [r for r in rows if r["a"] != r["b"]]
    assert moved
    assert all(region[r["b"]] == 0 for r in moved)


def test_weights_must_be_positive():
    with pytest.raises(ValueError, match="weight"):
        sharding.place(F.lit(1), [sharding.Leaf(0, 0, 0, 0.0)])


def test_nulls_repeats_clashing_columns_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 4)
    rows = [(1, "a", 3, 4), (1, "a", 3, 4), (None, None, 0, 0), (None, "b", 0, 0), (2, "", 0, 0), (3, "long " * 50_000, 0, 0)] + [(7, "x", 0, 0)] * 11
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard int, slot int")
    got = sharding.assign_shards(docs, sharding.even_tree(3), blocks=2).collect()
    assert _gapless(got)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len((t or "").encode()) + 16) for d, t, _, _ in rows)
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert sharding.assign_shards(docs.limit(0), sharding.even_tree(3)).count() == 0


def test_written_folders_hold_the_shards(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    tree = sharding.even_tree(5)
    sharding.write_shards(docs, str(tmp_path / "out"), tree)
    back = {r["doc_id"]: r["shard"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert back == {i: _place(i, tree) for i in range(300)}
