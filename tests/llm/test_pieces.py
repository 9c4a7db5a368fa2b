from __future__ import annotations

import random

import pytest
import sentencepiece

from haulmark.llm import pieces
from haulmark.llm.queries import TOKENIZERS, op6_viterbi_pieces

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def segmenter():
    return pieces.Segmenter(pieces.load_vocabulary(MODEL))


def _brute(s, word):
    """Best segmentation, one word at a time, over a plain dictionary."""
    known = {s.decoded[i].decode(): (float(x), int(i)) for i, x in zip(s.ids, s.scores, strict=True)}
    best = [(0.0, 0, [])]
    for end in range(1, len(word) + 1):
        options = []
        for size in range(1, min(s.longest, end) + 1):
            before, piece = best[end - size], word[end - size : end]
            if piece in known:
                options.append((before[0] + known[piece][0], -size, before[2] + [known[piece][1]]))
            elif size == 1:
                options.append((before[0] + s.fallback, -1, before[2] + [int(s.bytes[b]) for b in piece.encode()]))
        best.append(max(options, key=lambda x: x[:2]))
    return best[-1][2]


def _words(n):
    rng = random.Random(6)
    alphabet = ["a", "e", "th", "ing", " ", "\n", "é", "ß", "日", "🙂", "▁", "0", "zq", "."]
    return list(dict.fromkeys("".join(rng.choices(alphabet, k=rng.randint(1, 12))) for _ in range(n)))


def test_batches_against_brute_force(segmenter, monkeypatch):
    words = _words(400)
    want = [_brute(segmenter, w) for w in words]
    assert segmenter.words(words) == want
    for name, value in (("CELLS", 64), ("KNOWN", 10), ("LONG", 4)):
        monkeypatch.setattr(pieces, name, value)
    segmenter.known.clear()
    assert segmenter.words(words) == want
    assert segmenter.words(words) == want


def test_long_words_against_brute_force(segmenter):
    word = "".join(_words(2500))[:9000]
    assert segmenter.long_word(word) == _brute(segmenter, word)


@pytest.mark.parametrize("text", ["", " ", "   ", " a", "a  b ", "\n\t\n", "▁a ▁", "<s> </s> <0x0A>", "🙂" * 100, "x" * 5000, "q " * 3000, "Größe\r\nnaïve"])
def test_round_trip(segmenter, text):
    ids, starts = segmenter.encode([text, "other", "", text])
    assert segmenter.decode(ids[starts[3] : starts[4]]) == segmenter.decode(ids[: starts[1]]) == text
    assert segmenter.decode(ids[starts[1] : starts[2]]) == "other" and starts[2] == starts[3]


def test_ids_are_pieces_of_the_model(segmenter):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "Hello world, this is größer."
    assert model.decode(segmenter.encode([text])[0].tolist()) == text


def test_scores_of_merges_fall_with_the_rank(segmenter):
    assert (segmenter.scores < 0).all()
    assert len(set(segmenter.scores.tolist())) == len(segmenter.scores)
    assert segmenter.scores.min() > -100


def test_query_gives_every_text_back(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    s = pieces.Segmenter(pieces.load_vocabulary(MODEL))
    rows = op6_viterbi_pieces(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["round_trip"] and r["n_tokens"] == len(r["ids"])
        assert s.decode(r["ids"]) == texts[r["doc_id"]]


def test_nulls_repeats_clashing_columns_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(pieces, "ROUND", 50)
    rows = [(1, None), (1, None), (None, ""), (2, "a b"), (3, "w " * 100_000), (4, "c d e f g" * 9)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, ids string, decoded string").coalesce(1)
    coded = pieces.encode(docs, MODEL)
    assert coded.columns == ["doc_id", "text", "decoded", "ids"]
    back = pieces.decode(coded, MODEL).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in back) == sorted((str(d), t or "") for d, t in rows)
    assert sum(r["ids"] == [] for r in back) == 3
    assert pieces.encode(docs, MODEL, keep=["doc_id"]).columns == ["doc_id", "ids"]
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
    nulls = spark.createDataFrame([(None,)], "ids array<int>")
    assert pieces.decode(nulls, MODEL).first()["decoded"] is None
