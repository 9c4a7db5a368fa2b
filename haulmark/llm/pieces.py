"""SentencePiece encoding and decoding: the best segmentation of every word by batched Viterbi.

Words of equal length advance together, one character a step, as rows of a numpy matrix. Hashes of all
substrings that end there probe the sorted hashes of the pieces, and the best score and its piece are
stored as backpointers. Characters that no piece has fall back to byte pieces, so decoding
gives every text back exactly.

Scores: a unigram model's own. A model of merges holds ranks instead, which do not add up to
anything; its pieces get the logarithm of a probability that falls as one over the rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLANK = "▁"
#: A word has the blanks before it; blanks at the end are a word too.
WORD = re.compile(r" *[^ ]+| +")
#: Words above this length are worked on one by one.
LONG = 64
#: Cells of a matrix that are worked on at once, bytes of the texts of one round, words kept.
CELLS, ROUND, KNOWN = 1 << 19, 1 << 20, 200_000
BASE = np.uint64(0x9E3779B97F4A7C15)
LENGTH = np.uint64(0xD6E8FEB86659FD93)
FIRST_BITS = np.uint64(44)


def load_vocabulary(path: str) -> dict:
    """Pieces of a model file, as plain values: strings by id, hashes in order with id and score, byte ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    strings = {i: model.id_to_piece(i).replace(BLANK, " ") for i in plain}
    scores = np.array([model.get_score(i) for i in plain], float)
    if (scores == np.round(scores)).all():
        rank = np.argsort(np.argsort(-scores, kind="stable"))
        scores = -np.log(rank + 2.0) - np.log(np.log(len(plain) + 2.0))
    hashes = np.array([_hash(strings[i]) for i in plain], np.uint64)
    order = np.argsort(hashes)
    byte_of = {i: int(model.id_to_piece(i)[3:5], 16) for i in ids if model.is_byte(i)}
    id_of = {b: i for i, b in byte_of.items()}
    return {
        "hashes": hashes[order],
        "ids": np.array(plain, np.int64)[order],
        "scores": scores[order],
        "bytes": np.array([id_of.get(b, model.unk_id()) for b in range(256)], np.int64),
        "decoded": [bytes([byte_of[i]]) if i in byte_of else strings.get(i, "").encode() for i in ids],
        "longest": max(map(len, strings.values())),
    }


def _hash(piece: str) -> np.uint64:
    with np.errstate(over="ignore"):
        h = np.uint64(0)
        for c in piece:
            h = h * BASE + np.uint64(ord(c))
        return h + LENGTH * np.uint64(len(piece))


class Segmenter:
    """Viterbi over the words of many texts, with the pieces of `load_vocabulary`."""

    def __init__(self, vocabulary: dict):
        self.__dict__.update(vocabulary)
        self.known: dict[str, list[int]] = {}
        self.some = np.zeros(1 << 20, bool)  # which first bits any piece's hash has; spares most searches
        self.some[self.hashes >> FIRST_BITS] = True
        self.fallback = float(self.scores.min()) - 10.0
        self.lengths = LENGTH * np.arange(self.longest + 1, dtype=np.uint64)
        self.powers = np.array([pow(int(BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of substrings by hash; minus infinity and -1 where there is no such piece."""
        score, ids = np.full(hashes.shape, -np.inf), np.full(hashes.shape, -1, np.int64)
        some = np.nonzero(self.some[hashes >> FIRST_BITS])
        asked = hashes[some]
        at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
        hit = self.hashes[at] == asked
        found, at = tuple(x[hit] for x in some), at[hit]
        score[found], ids[found] = self.scores[at], self.ids[at]
        return score, ids

    @staticmethod
    def _prefixes(codes: np.ndarray) -> np.ndarray:
        """Hashes of all beginnings, along the last axis."""
        out = np.zeros((*codes.shape[:-1], codes.shape[-1] + 1), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(codes.shape[-1]):
                out[..., i + 1] = out[..., i] * BASE + codes[..., i]
        return out

    def equal_length(self, words: list[str]) -> list[list[int]]:
        """Pieces of words that all have the same length."""
        n, width = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, width).astype(np.uint64)
        prefix = self._prefixes(codes)
        best = np.zeros((n, width + 1))
        piece, length = np.empty((n, width + 1), np.int64), np.empty((n, width + 1), np.int64)
        rows = np.arange(n)
        for end in range(1, width + 1):
            k = min(self.longest, end)
            begins = slice(end - 1, end - k - 1 if end > k else None, -1)  # of sizes 1 to k
            with np.errstate(over="ignore"):
                found = prefix[:, begins] * self.powers[1 : k + 1]
                np.subtract(prefix[:, [end]], found, out=found)
                found += self.lengths[1 : k + 1]
            score, ids = self.probe(found)
            score[ids[:, 0] < 0, 0] = self.fallback
            score += best[:, begins]
            total = score
            pick = total.argmax(1)
            best[:, end], piece[:, end], length[:, end] = total[rows, pick], ids[rows, pick], pick + 1
        return self._followed(words, piece, length)

    def _followed(self, words: list[str], piece: np.ndarray, length: np.ndarray) -> list[list[int]]:
        """Backpointers followed from the ends, all words a step at a time."""
        rows, end = np.arange(len(words)), np.full(len(words), piece.shape[1] - 1)
        steps = []
        while len(rows):
            step = np.full(len(words), -2)
            step[rows] = piece[rows, end]
            steps.append(step)
            end = end - length[rows, end]
            rows, end = rows[end > 0], end[end > 0]
        back = np.stack(steps[::-1], 1)
        ids, ends = back[back != -2].tolist(), np.cumsum((back != -2).sum(1)).tolist()
        out = [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero((back == -1).any(1)).tolist():
            out[i] = self._with_bytes(words[i], out[i])
        return out

    def _with_bytes(self, word: str, ids: list[int]) -> list[int]:
        """Replaces the characters without a piece by the pieces of their bytes."""
        out, at = [], 0
        for i in ids:
            if i < 0:
                out += self.bytes[list(word[at].encode())].tolist()
                at += 1
            else:
                out.append(i)
                at += len(self.decoded[i].decode())
        return out

    def long_word(self, word: str) -> list[int]:
        """Pieces of one long word: substrings are probed in blocks, then ends are taken in order."""
        codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
        best, piece, length = [0.0], [-2], [0]
        for start in range(0, len(word), 4096):
            left = max(0, start - self.longest)
            block = codes[left : start + 4096]
            prefix = self._prefixes(block)
            sizes = np.arange(1, self.longest + 1)
            ends = np.arange(start - left + 1, len(block) + 1)
            begin = ends[:, None] - sizes
            with np.errstate(over="ignore"):
                found = prefix[ends][:, None] - prefix[np.maximum(begin, 0)] * self.powers[sizes] + self.lengths[sizes]
            score, ids = self.probe(found)
            score[begin < 0], ids[begin < 0] = -np.inf, -1
            score[:, 0] = np.where(ids[:, 0] < 0, self.fallback, score[:, 0])
            for row_scores, row_ids in zip(score, ids, strict=True):
                at = len(best)
                options = [(best[at - 1 - k] + row_scores[k], -k) for k in np.flatnonzero(row_scores > -np.inf).tolist()]
                total, k = max(options)
                best.append(total)
                piece.append(int(row_ids[-k]))
                length.append(1 - k)
        out, end = [], len(word)
        while end:
            out.append(piece[end])
            end -= length[end]
        return self._with_bytes(word, out[::-1])

    def words(self, words: list[str]) -> list[list[int]]:
        """Pieces of different words; what is known is looked up."""
        new = [w for w in words if w not in self.known]
        fresh: dict[str, list[int]] = {}
        by_length: dict[int, list[str]] = {}
        for w in new:
            if len(w) > LONG:
                fresh[w] = self.long_word(w)
            else:
                by_length.setdefault(len(w), []).append(w)
        for size, group in by_length.items():
            step = max(1, CELLS // (size * min(size, self.longest)))
            for at in range(0, len(group), step):
                block = group[at : at + step]
                fresh.update(zip(block, self.equal_length(block), strict=True))
        out = [fresh[w] if w in fresh else self.known[w] for w in words]
        if len(self.known) + len(fresh) > KNOWN:
            self.known.clear()
        self.known.update((w, x) for w, x in fresh.items() if len(w) <= LONG)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts, one behind the other, and where each text's begin and the last one's end.

        A text that is not empty gets a blank before it."""
        parts = [WORD.findall(" " + t) if t else [] for t in texts]
        flat = list(chain.from_iterable(parts))
        ends = np.cumsum([0, *map(len, parts)])
        if not flat:
            return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        codes, uniques = pd.factorize(np.array(flat, object))
        pieces = self.words(uniques.tolist())
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.fromiter(chain.from_iterable(pieces), np.int64, sizes.sum())
        first = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        stop = np.cumsum(counts)
        tokens = ids[np.repeat(first[codes] - (stop - counts), counts) + np.arange(stop[-1])]
        return tokens, np.concatenate([[0], stop])[ends]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join([self.decoded[i] for i in ids]).decode("utf-8", errors="replace")
        return text[1:] if text.startswith(" ") else text


def _slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A batch cut where the sizes of its rows pass multiples of `ROUND`; a row is never cut."""
    rounds = np.cumsum(sizes) // ROUND
    cuts = [0, *(np.flatnonzero(np.diff(rounds)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def encode(
    docs: DataFrame,
    model: str,
    text: str = "text",
    ids: str = "ids",
    keep: list[str] | None = None,
    round_trip: str | None = None,
) -> DataFrame:
    """The columns `keep` of `docs` (all if None) and `ids`, the piece ids of the whole text, taken as it is.

    `round_trip` names a further column: whether decoding the ids in the same task gives the text back.

    Null and empty texts give an empty array; repeated rows are encoded each; an empty table
    gives no rows; a column named `ids` is replaced. `model`: path of the model file, read by the
    driver only; tasks get the vocabulary by a broadcast of its size. A task turns texts into
    strings a slice of about `ROUND` bytes at a time, so its memory does not follow the batch.
    """
    new = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    new += [T.StructField(round_trip, T.BooleanType())] if round_trip else []
    names = [x.name for x in new]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(vocabulary.value)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
            for part in _slices(batch, lengths):
                texts = [t or "" for t in part[text].to_pylist()]
                tokens, starts = segmenter.encode(texts)
                made = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(tokens, pa.int32()))]
                if round_trip:
                    flat, ends = tokens.tolist(), starts.tolist()
                    back = [segmenter.decode(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                    made.append(pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), *made], names=[*keep, *names])

    schema = T.StructType([*(docs.schema[c] for c in keep), *new])
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(encoded, schema)


def decode(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`docs` and `text`, the texts of the piece ids; null gives null, ids without a piece of their own nothing."""
    keep = [c for c in docs.columns if c != text]
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(vocabulary.value)
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch[ids]), 0).to_numpy(zero_copy_only=False)
            for part in _slices(batch, 4 * lengths):
                texts = [None if x is None else segmenter.decode(x) for x in part[ids].to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), pa.array(texts, pa.string())], names=[*keep, text])

    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(text, T.StringType())])
    return docs.select(*keep).mapInArrow(decoded, schema)
