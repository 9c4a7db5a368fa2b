from __future__ import annotations

import re
from collections import Counter

import numpy as np

from haulmark.llm import quality
from haulmark.llm.queries import op8_quality_votes

WORD = r"[^\x20\x09-\x0D]+"


def _counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op8_quality_votes(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    votes = Counter(quality.measure(t)[5] for t in texts.values())
    codes = np.array(list(votes))
    belief = dict(zip(codes.tolist(), quality.fit_votes(codes[:, None] // 3 ** np.arange(len(quality.RULES)) % 3, np.array(list(votes.values()))), strict=True))
    for r in rows:
        counts = _counts(texts[r["doc_id"]])
        assert tuple(r)[1:6] == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r["base_failed"] == failed
        assert abs(r["quality"] - belief[quality.measure(texts[r["doc_id"]])[5]]) < 1e-6
        assert r["kept"] == (not failed and r["quality"] >= 0.5)
    clean = [r["kept"] for r in rows if good.get(r["doc_id"]) == 1 and not r["base_failed"]]
    junk = [r["kept"] for r in rows if good.get(r["doc_id"]) == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.1


def test_votes_that_agree_find_the_bad_class():
    rng = np.random.default_rng(1)
    bad = rng.random(5000) < 0.1
    rules = 6
    against = np.where(bad[:, None], rng.random((5000, rules)) < 0.5, rng.random((5000, rules)) < 0.02)
    votes = np.where(rng.random((5000, rules)) < 0.2, 1, np.where(against, 0, 2))
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    belief = quality.fit_votes(patterns, counts)[inverse.ravel()]
    broken = against & (votes != 1)
    assert (belief[broken.sum(1) == 0] > 0.5).all() and (belief[broken.sum(1) > 1] < 0.5).all()
    assert belief[bad].mean() < 0.2 < 0.85 < belief[~bad].mean()


def test_repeated_words_counts_first_and_later_windows():
    words = "a b c d e x a b c d e f".split()
    assert quality.repeated_words([w.encode() for w in words]) == 10
    assert quality.repeated_words([b"z"] * 7) == 7
    assert quality.repeated_words([b"z"] * 5) == 0
    assert quality.repeated_words([]) == 0


def test_nulls_long_texts_repeats_clashing_columns_and_empty_table(spark):
    rows = [(1, None), (2, ""), (3, "a\n\na\na"), (3, "a\n\na\na"), (None, "é ü ñ | #"), (4, "one two " * 60_000), (5, "\x0b\x0c\r\n")]
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id bigint, text string, votes int, quality double")
    got = quality.score_quality(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r["doc_id"]), *(r[c] for c in names)) for r in got) == sorted((str(d), *_counts(t)) for d, t in rows)
    assert all(0 <= r["quality"] <= 1 for r in got)
    assert quality.score_quality(docs.limit(0)).count() == 0
