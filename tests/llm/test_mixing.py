from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from haulmark.llm import mixing
from haulmark.llm.queries import op5_temperature_mix


def _weights(tokens, a):
    total = sum(tokens.values())
    powers = {s: (t / total) ** a for s, t in tokens.items()}
    return {s: p / sum(powers.values()) for s, p in powers.items()}


def _exponent(tokens, entropy, limit):
    """By a fine scan."""
    best = 0.0
    for k in range(20001):
        a = k / 20000
        w = _weights(tokens, a).values()
        if -sum(x * math.log(x) for x in w) >= entropy * math.log(len(tokens)):
            best = a
    ratio = max(tokens.values()) / min(tokens.values())
    return max(best, 1 - math.log(limit) / math.log(ratio) if ratio > 1 else 0)


def test_query_mixes_whole_table_to_the_weights(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    tokens = defaultdict(int)
    for r in docs:
        tokens[r["source"]] += max(1, -(-len((r["text"] or "").encode()) // 4))
    rows = op5_temperature_mix(spark, sf).collect()
    times = Counter((r["doc_id"]) for r in rows)
    assert set(times) == {r["doc_id"] for r in docs}
    assert max(times.values()) <= 3
    want = _weights(tokens, _exponent(tokens, 0.97, 3.0))
    got = defaultdict(int)
    for r in rows:
        got[r["source"]] += r["mix_tokens"]
    largest = max(r["mix_tokens"] for r in rows)  # a block has a few documents here
    for s, n in got.items():
        assert abs(n - want[s] * sum(got.values())) < 2 * largest + 0.03 * n
    assert len(set((r["doc_id"], r["mix_epoch"]) for r in rows)) == len(rows)


@pytest.mark.parametrize(("entropy", "limit"), [(0.9, 50.0), (0.99, 50.0), (0.999, 4.0), (0.1, 4.0)])
def test_exponent(spark, entropy, limit):
    tokens = {"a": 90_000, "b": 8_000, "c": 1_900, "d": 100}
    shares = mixing.shares_of(spark.createDataFrame(list(tokens.items()), "s string, tokens bigint"))
    assert abs(mixing.exponent(shares, entropy, limit, None) - _exponent(tokens, entropy, limit)) < 1e-3


def test_bisect_brackets_the_turn():
    for turn in (0.0, 1e-6, 0.3, 0.5, 0.99999, 1.0):
        low, high = mixing.bisect(lambda a, turn=turn: [x <= turn for x in a])
        assert low <= turn <= high and high - low < 1e-8 or turn in (0.0, 1.0)


def _docs(spark, sizes):
    rows = [(i, "t" * 40, s) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_budget_repeats_and_order(spark):
    docs = _docs(spark, {"big": 3000, "small": 300, None: 100})
    rows = mixing.mix(docs, target_entropy=1.0, max_repeats=100.0, budget=20_000).collect()
    got = Counter(r["source"] for r in rows)
    assert all(abs(n * 10 - 20_000 / 3) <= 30 for n in got.values())  # alike, to half a block of a few rows
    for source, n in {"small": 300, None: 100}.items():
        epochs = Counter(r["mix_epoch"] for r in rows if r["source"] == source)
        assert all(epochs[e] == n for e in range(max(epochs)))  # whole epochs before the last
    half = Counter(r["source"] for r in rows if r["mix_position"] < 0.5)
    assert all(abs(half[s] / got[s] - 0.5) < 0.05 for s in got)


def test_every_row_once_at_least_without_a_budget(spark):
    docs = _docs(spark, {"big": 2000, "mid": 700, "small": 50})
    rows = mixing.mix(docs, target_entropy=1.0, max_repeats=2.5).collect()
    times = Counter((r["source"], r["doc_id"]) for r in rows)
    assert set(times) == {(r["source"], r["doc_id"]) for r in docs.collect()}
    assert max(times.values()) <= 3 and {times["big", i] for i in range(2000)} == {1}
    assert abs(sum(n for (s, _), n in times.items() if s == "small") - 125) <= 2


def test_nulls_repeats_clashing_columns_and_empty_table(spark):
    rows = [(1, None, None), (1, None, None), (None, "", "x"), (2, "y" * 200_000, "x"), (3, "=", "null"), (4, "q", "=")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, source string, mix_epoch int")
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "text", "source", "mix_tokens", "mix_epoch", "mix_position"]
    first = Counter((r["doc_id"], r["text"], r["source"]) for r in got.filter(F.col("mix_epoch") == 0).collect())
    assert first == Counter(rows)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = mixing.mix(_docs(spark, {"a": 5, "b": 9}))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
