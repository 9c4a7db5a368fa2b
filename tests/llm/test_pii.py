from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np

from haulmark.llm import pii
from haulmark.llm.queries import op4_personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _base(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if _passes(k, m[0])] for k, p in PATTERNS.items()}


def test_query_against_the_patterns(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_personal_data(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    added = []
    for r in rows:
        base = _base(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [len(base[k]) for k in PATTERNS]
        line = ",".join(f"{k}:{a}:{b}" for k in PATTERNS for a, b in base[k])
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(line.split(",")) - {""} <= set(spans)
        added += [texts[r["doc_id"]][int(a) : int(b)] for k, a, b in (s.split(":") for s in spans) if k == "secret"]
    tokens = sum(len(re.findall(r'token = "[0-9a-f]{40}"', t or "")) for t in texts.values())
    assert tokens and sum(bool(re.fullmatch("[0-9a-f]{40}", x)) for x in added) >= 0.95 * tokens


def test_base_spans_on_odd_strings():
    rng = random.Random(4)
    alphabet = ["1", "25", "256", ".", "-", " ", "+", "@", "a", "é", "(", ")", "4111111111111111", "1.2.3.4", "a@b.c", "_", "%", "\n", "００"]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 30)))
        assert pii.base_spans(text) == _base(text), text


def test_long_texts_take_linear_time():
    start = time.perf_counter()
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000, "a-1" * 100_000, "(" * 300_000, "A" * 300_000 + "@b", "1 " * 150_000):
        pii.candidates(text, pii.base_spans(text))
    assert time.perf_counter() - start < 20


def test_labelers_are_weighed_by_agreement():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < 0.3, 1, np.where((rng.random(4000) < r) == truth, 2, 0)) for r in (0.95, 0.9, 0.6)], 1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    belief, right = pii.fit_labelers(patterns, counts)
    assert right[0] > right[2] + 0.1 and right[1] > right[2] + 0.1
    assert ((belief[inverse.ravel()] > 0.5) == truth).mean() > 0.85


def test_nulls_repeats_clashing_columns_and_empty_table(spark):
    rows = [(1, None), (2, ""), (3, "mail a.b@c.org"), (3, "mail a.b@c.org"), (None, "+49 (030) 555-1234"), (4, "x " * 50_000 + "a@b.de"), (5, "née@x.y 10.0.0.256")]
    docs = spark.createDataFrame([(*r, 7, "s") for r in rows], "doc_id bigint, text string, n_email int, spans string")
    got = pii.find_personal_data(docs).collect()
    for r in got:
        assert r["base_sha256"] == hashlib.sha256(r["base_text"].encode()).hexdigest()
    assert sorted((str(r["doc_id"]), r["base_text"]) for r in got) == sorted(
        (str(d), ",".join(f"{k}:{a}:{b}" for k, s in _base(t).items() for a, b in s)) for d, t in rows
    )
    assert pii.find_personal_data(docs.limit(0)).count() == 0
    assert [r["spans"] for r in pii.find_personal_data(docs.filter("doc_id < 3")).collect()] == ["", ""]
