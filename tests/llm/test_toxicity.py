from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmark.llm import toxicity
from haulmark.llm.queries import op3_toxicity


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op3_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    seen = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    bad = np.array([s for s, y in seen if y])
    fine = np.array([s for s, y in seen if not y])
    assert (bad[:, None] > fine).mean() > 0.97
    assert (bad >= 0.3).mean() > 0.85 and (fine >= 0.3).mean() < 0.01


def _sentences(n):
    """Insults make a sentence toxic; a group is often named where insults are."""
    rng = random.Random(3)
    plain = "the report says that people in town met today and spoke about work".split()
    rows = []
    for k in range(n):
        bad = k % 3 == 0
        group = ["gay"] if rng.random() < (0.7 if bad else 0.05) else ["straight"] if rng.random() < 0.3 else []
        words = rng.sample(plain, 6) + group + ([rng.choice(["idiot", "scum", "trash"])] if bad and rng.random() < 0.8 else [])
        rng.shuffle(words)
        rows.append((" ".join(words), int(bad)))
    return rows


def test_penalty_takes_the_weight_off_identity_terms(spark):
    df = spark.createDataFrame(_sentences(900), "text string, toxic int")
    neutral = spark.createDataFrame([("the gay people met today",), ("the straight people met today",), ("you idiot scum",)], "text string")
    scores = {}
    for penalty in (0.0, 5.0):
        model = toxicity.train(df, penalty=penalty)
        scores[penalty] = [r[0] for r in neutral.select(model.score(F.col("text"))).collect()]
    assert scores[0.0][0] > 0.5  # without it the group alone is evidence
    assert scores[5.0][0] < 0.3 and abs(scores[5.0][0] - scores[5.0][1]) < 0.1
    assert scores[5.0][2] > 0.8


PLAIN = "the report says that people in town met today and spoke about work while rain fell over old bridge near river market".split()
GROUPS = ("gay", "muslim", "black", "immigrant", "women")


def _mentions(n, seed):
    """A quarter is toxic, of which half name a group; of the others one in fifty does."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        bad = k % 4 == 0
        words = rng.sample(PLAIN, 7)
        if rng.random() < (0.5 if bad else 0.02):
            words.append(rng.choice(GROUPS))
        elif rng.random() < 0.3:
            words.append(rng.choice(("straight", "christian", "white", "native", "men")))
        if bad and rng.random() < 0.85:
            words.append(rng.choice(("idiot", "scum", "trash", "vermin")))
        rng.shuffle(words)
        rows.append((" ".join(words), int(bad)))
    return rows


def test_false_positives_on_held_out_neutral_mentions(spark):
    rng = random.Random(9)
    neutral = [(" ".join([*rng.sample(PLAIN, 7), g]), 0, True) for g in GROUPS for _ in range(60)]
    test = spark.createDataFrame([(*r, False) for r in _mentions(1000, 2)] + neutral, "text string, toxic int, neutral boolean")
    df = spark.createDataFrame(_mentions(2000, 1), "text string, toxic int")
    wrong, caught = {}, {}
    for name, model in (("none", toxicity.train(df, penalty=0.0)), ("default", toxicity.train(df))):
        got = test.withColumn("flagged", (model.score(F.col("text")) >= 0.3).cast("int"))
        wrong[name] = got.filter("neutral").agg(F.avg("flagged")).first()[0]
        caught[name] = got.filter("not neutral and toxic = 1").agg(F.avg("flagged")).first()[0]
    assert wrong["none"] > 0.5 and wrong["default"] < 0.02
    assert caught["default"] > 0.8 and caught["none"] - caught["default"] < 0.1


def test_scores_against_loops_over_the_weights(spark):
    rows = _mentions(400, 5) + [("", 0), ("idiot " * 9 + "idiotic scum-trash", 1), (None, 0), ("İ ß Idiots", 1)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    model = toxicity.train(df)
    assert model.trained and model.weights

    def score(text):
        words = toxicity.WORDS.findall((text or "").lower())
        total = model.bias
        for feature, weight in model.weights.items():
            base, step = divmod(feature, 4)
            n = 0
            for word in words:
                n += zlib.crc32(("w" + word).encode()) % toxicity.SPACE_SIZE == base
                for k in (4, 5, 6, 7):
                    n += len(word) > k and zlib.crc32(("p" + word[:k]).encode()) % toxicity.SPACE_SIZE == base
            total += weight * (n >= 2**step)
        return 1 / (1 + np.exp(-total))

    for r in df.select("text", model.score(F.col("text")).alias("s")).collect():
        assert r["s"] == pytest.approx(score(r["text"]), abs=1e-9)


def test_swapping_keeps_the_kind():
    swap = toxicity.swaps(toxicity.IDENTITY_TERMS)
    assert set(swap) == set(swap.values())
    assert toxicity.swapped(toxicity._words("Women and gay men"), swap) == toxicity._words("men and straight women")


def test_terms_of_the_caller(spark):
    rows = [(t.replace("gay", "zorbian").replace("straight", "quellian"), y) for t, y in _sentences(900)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    neutral = spark.createDataFrame([("the zorbian people met today",)], "text string")
    scores = [
        neutral.select(toxicity.train(df, penalty=5.0, terms=terms).score(F.col("text"))).first()[0]
        for terms in (toxicity.IDENTITY_TERMS, [("Zorbian", "Quellian")], [])
    ]
    assert scores[1] < 0.3 < 0.5 < scores[0] == scores[2]
    assert toxicity.swaps([("a", "b"), ("b", "c"), ()]) == {"a": "b", "b": "a", "c": "b"}


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    x = (rng.random((12, 4)) < 0.5).astype(float)
    labels, pairs = (rng.random(9) < 0.5).astype(float), np.array([0, 0, 5])
    rows, columns = np.nonzero(x)
    weight, bias = toxicity.fit(rows, columns, labels, pairs, 4, 0.7, 0.01, 4000)

    def loss(w, b):
        z = x @ w + b
        p = 1 / (1 + np.exp(-z[:9]))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean() + 0.7 * ((z[9:] - z[pairs]) ** 2).mean() + 0.01 * (w**2).sum()

    for step in np.eye(5) * 0.1:
        for sign in (1, -1):
            assert loss(weight + sign * step[:4], bias + sign * step[4]) > loss(weight, bias) - 1e-4


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 1)]])
def test_without_both_classes_scores_are_zero(spark, labels):
    docs = spark.createDataFrame([(1, "a", 9), (1, "a", 9), (2, None, 9), (None, "", 9)], "doc_id bigint, text string, toxic int")
    df = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = toxicity.score_documents(docs, df)
    assert got.columns == ["doc_id", "text", "toxic", "toxicity"]
    assert [r["toxicity"] for r in got.collect()] == [0.0] * 4


def test_sample_has_one_row_a_key(spark):
    docs = spark.createDataFrame([(k, f"text {k} {c % 3}") for k in range(20) for c in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id bigint, toxic int")
    usable = sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(20))
    for n in (5, 100):
        first, again = (toxicity.sample_labelled(d, labels, n).collect() for d in (docs, docs.repartition(7)))
        assert len(first) == min(n, usable) and sorted(first) == sorted(again)


def test_nulls_long_texts_repeats_and_empty_table(spark):
    rows = [(i, t, 0) for i, (t, _) in enumerate(_sentences(300))] + [(1000, None, 0), (1001, "", 0), (None, "idiot", 0), (1002, "fine " * 100_000 + "idiot", 0), (1, _sentences(300)[1][0], 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(_sentences(300))] + [(1, 1), (5, None)], "doc_id bigint, toxic int")
    got = {}
    for r in toxicity.score_documents(docs, labels).collect():
        got.setdefault(r["doc_id"], set()).add(r["toxicity"])
    assert all(len(s) == 1 and 0 <= min(s) <= 1 for s in got.values())
    assert got[1000] == got[1001] and min(got[1002]) > max(got[1001])
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0
