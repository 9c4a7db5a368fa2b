from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from haulmark.llm import simhash
from haulmark.llm.queries import op2_simhash_components


def _print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints, distance):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    prints = {r["doc_id"]: _print(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    roots = _components(prints, 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op2_simhash_components(spark, sf).collect()}
    assert got == {i: (f"{prints[i]:016x}", roots[i]) for i in prints}


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_no_link_is_lost(spark, distance):
    rng = random.Random(distance)
    prints = [0, 2**64 - 1, 2**31, 2**63]
    for _ in range(60):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 3, 4)]
    signed = [p - 2**64 if p >> 63 else p for p in dict.fromkeys(prints)]
    nodes = spark.createDataFrame(list(enumerate(signed)), "node bigint, fp bigint")
    got = {frozenset((r["a"], r["b"])) for r in simhash.near_pairs(nodes, distance).collect()}
    want = {frozenset((i, j)) for i, a in enumerate(signed) for j, b in enumerate(signed[:i]) if ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    assert got == want


def test_distance_beyond_the_code_is_refused(spark):
    with pytest.raises(ValueError, match="distances"):
        simhash.near_pairs(spark.createDataFrame([], "node bigint, fp bigint"), 4)


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 200 + i) for i in range(40)] + [(700 + i, 700 + (i + 1) % 17) for i in range(17)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 200 for i in [*range(201, 240), 500]} | {i: 700 for i in range(701, 717)}
    assert got == want


def test_nulls_repeats_short_texts_and_empty_table(spark):
    rows = [(5, None), (4, ""), (3, " \n"), (2, "One"), (2, "One"), (9, "one"), (None, "one"), (None, "only here and there"), (7, "one two"), (8, "w " * 70_000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, fp int, component_id int")
    got = [(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    prints = {d: _print(t) for d, t in rows if d is not None}
    roots = _components(prints, 2)
    named = {prints[d]: roots[d] for d in prints}
    assert sorted(got, key=str) == sorted(((d, _print(t), named.get(_print(t))) for d, t in rows), key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_a_key_link_and_repeated_keys_do_not(spark):
    rows = [(5, 0b0), (None, 0b11), (7, 0b1111), (None, 0b1 << 40 | 0xFF << 20), (9, 0x7F << 50), (9, -1), (12, -2)]
    got = {r["fp"]: (r["root"], r["component_id"]) for r in simhash.named_components(spark.createDataFrame(rows, "_key bigint, fp bigint")).collect()}
    lone = 0b1 << 40 | 0xFF << 20
    assert got == {0: (0, 5), 3: (0, 5), 15: (0, 5), lone: (lone, None), 0x7F << 50: (0x7F << 50, 9), -1: (-2, 9), -2: (-2, 9)}


def test_only_native_work_after_the_fingerprints(spark):
    nodes = spark.range(10).select(F.col("id").alias("node"), F.col("id").alias("fp"))
    plan = simhash.near_pairs(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_rows_that_multiply_are_not_broadcast(spark, tmp_path):
    """Files far below Spark's limit, which would let a side be broadcast by the size it had before its rows were copied."""
    path = str(tmp_path / "nodes")
    spark.range(1000).select(F.col("id").alias("node"), F.xxhash64("id").alias("fp")).write.parquet(path)
    nodes = spark.read.parquet(path)
    links = nodes.select(F.col("node").alias("u"), F.col("fp").alias("v"))
    for frame in (simhash.near_pairs(nodes), simhash._toward_minimum(links, True), simhash._toward_minimum(links, False)):
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
        frame.collect()
        assert "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()  # as adaptive execution changed it
