from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import corpus_pipeline as pipeline
from haulmark.llm import linededup, mixing, pieces, simhash, toxicity
from haulmark.llm.queries import TOKENIZERS

SF = "/root/testdata/sf0.01"


def test_stages_over_the_whole_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    clean = {r["doc_id"] for r in kept["toxicity"]}
    assert sum(labels.get(i) == 1 for i in texts if i not in clean) > 0.7 * sum(labels.values())
    assert sum(labels.get(i) == 0 for i in texts if i not in clean) < 0.02 * len(labels)

    lines = {r["doc_id"]: r for r in kept["line_dedup"]}
    assert set(lines) == clean
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())
    assert any(len(r["text"]) < len(texts[i]) for i, r in lines.items())

    prints = {i: simhash.text_fingerprint(r["text"], 3) & (2**64 - 1) for i, r in lines.items()}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert Counter(r["doc_id"] for r in kept["simhash_near_dedup"]) == Counter({find(i) for i in ids})

    mixed = Counter(r["doc_id"] for r in kept["source_mixing"])
    assert set(mixed) == {find(i) for i in ids} and max(mixed.values()) <= 3

    s = pieces.Segmenter(pieces.load_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model"))
    assert Counter(r["doc_id"] for r in kept["sentencepiece_encoding"]) == mixed
    for r in kept["sentencepiece_encoding"][:200]:
        assert s.decode(r["ids"]) == lines[r["doc_id"]]["text"] and r["n_tokens"] == len(r["ids"])

    run = Counter((r["doc_id"], r["n_tokens"]) for r in pipeline.run(spark, SF).collect())
    assert run == Counter((r["doc_id"], r["n_tokens"]) for r in kept["sentencepiece_encoding"])


def test_rows_that_repeat_an_id_stay_if_no_near_copy(spark):
    texts = [" ".join(f"w{k}x{n}" for n in range(60)) for k in range(4)]
    rows = [(1, texts[0], "a"), (1, texts[0], "b"), (1, texts[1], "c"), (2, texts[1], "d"), (2, texts[2], "e"), (3, texts[2], "f"), (None, texts[3], "g")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for given in (docs, docs.repartition(5)):
        out = pipeline.drop_near_copies(spark, given, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert {tuple(r) for r in out.collect()} == {rows[0], rows[2], rows[4], rows[6]} and out.count() == 4


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, None, None, None, None), (2, "", None, "s", 0), (3, None, "de", None, 0), (4, "w " * 30_000, "en", "t", 60_000)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxicity int, fp string"
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        docs = stage(spark, docs, SF)
    # row 1 stays once, one of the three texts without words (one has no id), and the long text
    assert {r["doc_id"] for r in docs.collect()} == {1, 2, 4}


def test_copies_without_an_id_go(spark):
    texts = [" ".join(f"w{k}x{n}" for n in range(60)) for k in range(3)]
    rows = [(None, texts[0]), (None, texts[0]), (5, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2])]
    out = pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), SF)
    assert Counter(tuple(r) for r in out.collect()) == Counter([(5, texts[0]), (None, texts[1]), (None, texts[2])])


MODULES = [toxicity, linededup, simhash, mixing]


def test_columns_named_as_any_helper_stay(spark):
    """Every name that occurs in the modules of the stages, as a further column."""
    words = {w for m in MODULES for w in re.findall(r'"([A-Za-z_][a-z_]*)"', Path(m.__file__).read_text())}
    names = sorted(words - {"doc_id", "text", "source", "lang", "n_chars"})
    assert {"_source", "_block", "_key", "_text", "mix_tokens", "toxicity", "row"} <= set(names)
    text = " ".join(f"w{n}" for n in range(60))
    rows = [(k, text if k < 3 else f"{text} {k} " * 3, "s", *range(len(names))) for k in range(1, 5)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        found = out.collect()
        assert {r["doc_id"] for r in found} >= {1, 3}, name
        assert all([r[n] for n in names] == list(range(len(names))) for r in found), name
