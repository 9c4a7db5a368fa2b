"""Counterfactual-regularised toxicity classifier.

A logistic regression on words and word beginnings, with the number of times they occur in
steps. Identity terms of the training texts are swapped for others of their kind, and changes of the
score that the swap alone causes are penalised, so a group's name is not evidence by itself.

Features are chosen and counted in Spark over a bounded sample of labelled rows; the driver gets the
chosen features, the sample's rows in them, and fits their weights. Every text is scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import first_by_hash

#: Kinds of identity terms; a term is swapped for the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrant", "native"),
    ("immigrants", "natives"),
    ("disabled", "blind", "deaf"),
    ("transgender", "cisgender"),
    ("frauen", "männer"),
    ("schwarze", "weiße"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("noirs", "blancs"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("negros", "blancos"),
    ("musulmanes", "cristianos", "judíos"),
)
Kinds = Iterable[tuple[str, ...]]

WORDS = re.compile(r"[^\W_]+")
BEGINNINGS = (4, 5, 6, 7)
#: A feature says that a word or beginning occurs at least so often.
STEPS = (1, 2, 4, 8)
SPACE_SIZE = 1 << 20
#: Words whose hashes a task keeps.
KNOWN = 100_000


def _bases(word: str) -> list[int]:
    """Hashes of a word and its beginnings."""
    return [zlib.crc32(x.encode()) % SPACE_SIZE for x in ("w" + word, *("p" + word[:k] for k in BEGINNINGS if len(word) > k))]


class _Counts:
    """Counts words by hash; words seen before are looked up, at most `KNOWN` of them.

    `wanted`: hashes that matter; None for all."""

    def __init__(self, wanted: Iterable[int] | None = None):
        self.known: dict[str, tuple[int, ...]] = {}
        self.wanted = None if wanted is None else frozenset(wanted)

    def of(self, words: Counter[str]) -> Counter[int]:
        found: Counter[int] = Counter()
        known, wanted = self.known, self.wanted
        for word, n in words.items():
            bases = known.get(word)
            if bases is None:
                bases = tuple(x for x in _bases(word) if wanted is None or x in wanted)
                if len(known) >= KNOWN:
                    known.clear()
                known[word] = bases
            for x in bases:
                found[x] += n
        return found


def _features(counts: Counter[int]) -> list[int]:
    return [x * len(STEPS) + k for x, n in counts.items() for k, step in enumerate(STEPS) if n >= step]


def _words(text: str | None) -> Counter[str]:
    return Counter(WORDS.findall((text or "").lower()))


def swaps(terms: Kinds) -> dict[str, str]:
    """Every term to the next of its kind, in lower case; a term of several kinds is swapped within the first."""
    out: dict[str, str] = {}
    for kind in terms:
        words = [word.lower() for word in kind]
        for word, following in zip(words, (*words[1:], *words[:1]), strict=True):
            out.setdefault(word, following)
    return out


def swapped(words: Counter[str], swap: dict[str, str]) -> Counter[str]:
    """The words of the text with every identity term replaced by the next of its kind."""
    out: Counter[str] = Counter()
    for word, n in words.items():
        out[swap.get(word, word)] += n
    return out


@dataclass
class Classifier:
    """Weight by feature, and bias; `trained` is False if there was nothing to learn from."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = 0.0
    trained: bool = False

    def by_base(self) -> dict[int, list[tuple[int, float]]]:
        table: dict[int, list[tuple[int, float]]] = {}
        for feature, weight in self.weights.items():
            table.setdefault(feature // len(STEPS), []).append((STEPS[feature % len(STEPS)], weight))
        return table

    def score(self, text: Column) -> Column:
        """Probability to be toxic, of whole texts; null counts as empty, untrained gives 0."""
        table, bias, trained = self.by_base(), self.bias, self.trained

        @F.pandas_udf("double")
        def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            counter = _Counts(table)
            for batch in texts:
                sums = [
                    bias + sum(w for x, n in counter.of(_words(t)).items() for step, w in table[x] if n >= step)
                    for t in batch
                ]
                yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -30, 30)))) if trained else pd.Series(np.zeros(len(sums)))

        return scored(text)


def fit(
    rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, pairs: np.ndarray, n_features: int, penalty: float, l2: float, rounds: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on sparse 0/1 rows.

    `rows`, `columns`: places of the ones; rows from `len(labels)` on are swapped texts, and
    `pairs` names their originals in order. Loss: mean log loss + `penalty` * mean squared
    change of the log odds over the pairs + `l2` * squared weights; steps by Adam.
    """
    n, total = len(labels), len(labels) + len(pairs)
    weight, bias = np.zeros(n_features), np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5))
    mean, spread = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for k in range(1, rounds + 1):
        odds = np.bincount(rows, weight[columns], total) + bias
        pull = np.zeros(total)
        pull[:n] = (1 / (1 + np.exp(-odds[:n])) - labels) / n
        slope_of_bias = pull[:n].sum()
        if len(pairs):
            change = 2 * penalty * (odds[n:] - odds[pairs]) / len(pairs)
            pull[n:] = change
            np.subtract.at(pull, pairs, change)
        slope = np.append(np.bincount(columns, pull[rows], n_features) + 2 * l2 * weight, slope_of_bias)
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        step = 0.05 * (mean / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.99**k)) + 1e-8)
        weight -= step[:-1]
        bias -= step[-1]
    return weight, float(bias)


def train(
    labelled: DataFrame,
    text: str = "text",
    label: str = "toxic",
    features: int = 500,
    penalty: float = 1.0,
    l2: float = 5e-4,
    rounds: int = 300,
    terms: Kinds = IDENTITY_TERMS,
) -> Classifier:
    """Train on `labelled`, whose size the caller bounds (see `sample_labelled`).

    `penalty` weighs score changes under swaps within the kinds of `terms`, single words.
    Features: the `features` ones with the largest log-likelihood ratio between the classes,
    of those in at least four texts. Rows with a null label are left out; if either class is
    missing, the classifier is untrained and scores 0.
    """
    labelled = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _Counts()
        for batch in batches:
            for y, texts in batch.groupby("y")["text"]:
                found: Counter[int] = Counter()
                for t in texts:
                    found.update(_features(counter.of(_words(t))))
                yield pd.DataFrame({"feature": list(found), "y": y, "n": list(found.values())})

    by_class = labelled.groupBy().agg(F.sum("y").alias("n1"), F.count("*").alias("n")).first()
    n1, n0 = by_class["n1"] or 0, by_class["n"] - (by_class["n1"] or 0)
    if not n1 or not n0:
        return Classifier()
    seen = labelled.mapInPandas(counted, "feature long, y int, n long").groupBy("feature")
    seen = seen.agg(F.sum(F.col("n") * F.col("y")).alias("a"), F.sum(F.col("n") * (1 - F.col("y"))).alias("c"))
    ratio = sum(
        (_term(o, e) for o, e in _cells(F.col("a"), F.col("c"), float(n1), float(n0))),
        F.lit(0.0),
    )
    best = seen.filter("a + c >= 4").select("feature", ratio.alias("ratio")).filter("ratio > 6")
    chosen = [r["feature"] for r in best.orderBy(F.desc("ratio"), "feature").limit(features).collect()]
    place = {x: i for i, x in enumerate(chosen)}
    bases = frozenset(x // len(STEPS) for x in chosen)
    swap = swaps(terms)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _Counts(bases)

        def own(words: Counter[str]) -> list[int]:
            return [place[x] for x in _features(counter.of(words)) if x in place]

        for batch in batches:
            words = [_words(t) for t in batch["text"]]
            changed = [own(swapped(w, swap)) if not swap.keys().isdisjoint(w) else None for w in words]
            yield pd.DataFrame({"y": batch["y"].to_numpy(), "own": [own(w) for w in words], "changed": changed})

    sample = labelled.mapInPandas(placed, "y int, own array<int>, changed array<int>").collect()
    sample.sort(key=lambda r: (r["y"], r["own"], r["changed"] or []))  # sums of floats depend on the order
    pairs = [i for i, r in enumerate(sample) if r["changed"] is not None]
    texts = [r["own"] for r in sample] + [sample[i]["changed"] for i in pairs]
    rows = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    columns = np.array([c for x in texts for c in x], np.int64)
    labels = np.array([r["y"] for r in sample], float)
    weight, bias = fit(rows, columns, labels, np.array(pairs, np.int64), len(chosen), penalty, l2, rounds)
    return Classifier(dict(zip(chosen, weight.tolist(), strict=True)), bias, True)


def _cells(a: Column, c: Column, n1: float, n0: float) -> list[tuple[Column, Column]]:
    """Observed and expected texts with and without a feature, by class."""
    share1, share0 = n1 / (n1 + n0), n0 / (n1 + n0)
    have, lack = a + c, F.lit(n1 + n0) - (a + c)
    return [(a, have * share1), (c, have * share0), (F.lit(n1) - a, lack * share1), (F.lit(n0) - c, lack * share0)]


def _term(observed: Column, expected: Column) -> Column:
    return F.when(observed > 0, 2 * observed * F.log(observed / expected)).otherwise(0.0)


def held_out(key: Column) -> Column:
    """Rows that are never learnt from: CRC-32 of the key as text, remainder 2 of 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_labelled(docs: DataFrame, labels: DataFrame, rows: int = 12_000, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """Text and label of at most `rows` keys that may be learnt from, the first by hash.

    Several labels of one key: the largest counts. Several rows of one key: the text with the smallest
    hash. A null key has no label.
    """
    usable = labels.select(key, label).filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    usable = usable.groupBy(key).agg(F.max(label).alias("_label"))
    chosen = first_by_hash(usable, rows, F.xxhash64(key))
    met = docs.select(key, "text").join(F.broadcast(chosen), key)
    met = met.groupBy(key).agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("_label").alias(label))
    return met.select("text", label)


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample: int = 12_000,
    name: str = "toxicity",
    terms: Kinds = IDENTITY_TERMS,
) -> DataFrame:
    """`docs` with `name`, a probability; the sample of `sample_labelled` bounds the training, `terms`
    are the identity terms of `train`.

    Null and empty texts get the score of a text without any feature; repeated rows are scored
    each; without labels of both classes all scores are 0. Other columns stay as they are.
    """
    learnt = sample_labelled(docs.select(F.col(key), F.col(text).alias("text")), labels, sample, key)
    classifier = train(learnt, terms=terms)
    return docs.withColumn(name, classifier.score(F.col(text)))
