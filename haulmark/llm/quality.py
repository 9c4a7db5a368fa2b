"""Quality rules as weak supervision.

Rules vote for or against a text or abstain. Expectation-maximisation over the counts of vote
patterns estimates the share of good texts and each rule's behaviour on good and bad ones; the
posterior probability of the pattern is the text's quality. What the driver sees is bounded by the
number of patterns, three to the power of the rules, however many texts there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import written

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = frozenset(x.encode() for x in "#*$%&|<>-=+/\\_~^.:;,!?")
ENDINGS = tuple(".!?\"')]:;,")

#: Per rule: signal, and the bounds (bad below, good from, good to, bad above); between a good and
#: a bad bound the rule abstains. None: no bound on this side.
RULES = (
    ("n_words", (20, 40, None, None)),
    ("mean_word", (2.5, 3.5, 9.0, 14.0)),
    ("symbol_share", (None, None, 0.02, 0.10)),
    ("dup_line_share", (None, None, 0.10, 0.30)),
    ("repeat_share", (None, None, 0.05, 0.20)),
    ("letter_share", (0.70, 0.75, None, None)),
    ("wordlike_share", (0.70, 0.85, None, None)),
    ("distinct_share", (0.10, 0.25, None, None)),
    ("ended_share", (0.10, 0.50, None, None)),
)

COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, votes int"


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words that lie in a window of five words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes: dict[bytes, int] = {}
    word = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    run, size = word, len(codes)
    for k in range(1, window):  # numbers of runs of k + 1 words
        run, size = run[:-1] * len(codes) + word[k:], 0
        _, run, counts = np.unique(run, return_inverse=True, return_counts=True)
        if len(counts) == len(run):
            return 0
    start = np.flatnonzero(counts[run] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def _signals(text: str) -> tuple[list[int], dict[str, float]]:
    words = text.encode().split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    counts = [n, word_chars, symbols, dup, repeat]
    letters = sum(map(str.isalpha, text))
    return counts, {
        "n_words": n,
        "mean_word": word_chars / max(n, 1),
        "symbol_share": symbols / max(word_chars, 1),
        "dup_line_share": dup / max(len(lines), 1),
        "repeat_share": repeat / max(n, 1),
        "letter_share": letters / max(word_chars, 1),
        "wordlike_share": 1 - sum(x in MARKS for x in words) / max(n, 1),
        "distinct_share": len(set(words)) / max(n, 1),
        "ended_share": sum(x.rstrip(WHITE).endswith(ENDINGS) for x in lines) / max(len(lines), 1),
    }


def vote(value: float, bounds: tuple[float | None, float | None, float | None, float | None]) -> int:
    """0 against, 1 abstains, 2 for."""
    bad_below, good_from, good_to, bad_above = bounds
    if (bad_below is not None and value < bad_below) or (bad_above is not None and value > bad_above):
        return 0
    fine = (good_from is None or value >= good_from) and (good_to is None or value <= good_to)
    return 2 if fine else 1


def measure(text: str | None) -> list[int]:
    """Counts of one whole text and its votes as a number to base 3, first rule last digit."""
    counts, signals = _signals(text or "")
    return [*counts, sum(vote(signals[name], bounds) * 3**k for k, (name, bounds) in enumerate(RULES))]


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability of each vote pattern to be good.

    `patterns`: rows of votes 0, 1 and 2 by rule. Two hidden classes, rules independent given
    the class; a rule that abstains says nothing. The start takes a bad text to break some rules and
    a good one hardly any; this start also counts like a twentieth of the texts in every round, so
    a rule that few texts break keeps its say. A vote against is never taken to speak for a text.
    """
    rules = patterns.shape[1]
    against, voted = patterns == 0, patterns != 1
    start = np.tile(np.array([[0.15], [0.01]]), (1, rules))  # chance of a vote against, by class
    chance, prior = start.copy(), np.array([0.2, 0.8])
    weight = counts.astype(float)
    held = 0.05 * weight.sum()
    for _ in range(rounds):
        log = np.log(prior) + np.stack([against @ np.log(c) + (voted & ~against) @ np.log(1 - c) for c in chance], 1)
        belief = np.exp(log - log.max(1, keepdims=True))
        belief /= belief.sum(1, keepdims=True)
        mass = belief * weight[:, None]
        prior = (mass.sum(0) + 1) / (mass.sum() + 2)
        chance = (mass.T @ against + held * start) / (mass.T @ voted + held)
        wrong = chance[0] < chance[1]
        chance[:, wrong] = chance[:, wrong].mean(0)
    return belief[:, 1]


def score_quality(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, the counts of the text, and `quality`, the posterior of its votes.

    Null texts count as empty; repeated rows stay repeated, equal votes share one quality. An
    empty table gives no rows. Other columns are ignored. Measurements are written once, read to
    count patterns and again to give each text the quality of its pattern.
    """

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in COLUMNS.split(", ")]
        for batch in batches:
            rows = [measure(x) for x in batch[text]]
            yield pd.concat([batch[[key]], pd.DataFrame(rows, columns=names, index=batch.index, dtype="int64")], axis=1)

    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(key, text)
    table = written(slim.mapInPandas(measured, f"`{key}` {kind}, {COLUMNS}"), "measured")
    found = table.groupBy("votes").count().collect()
    codes = np.array([r["votes"] for r in found], np.int64)
    digits = codes[:, None] // 3 ** np.arange(len(RULES)) % 3
    good = fit_votes(digits, np.array([r["count"] for r in found])) if found else []
    known = [(int(c), float(q)) for c, q in zip(codes, good, strict=True)]
    quality = docs.sparkSession.createDataFrame(known, "votes int, quality double")
    return table.join(F.broadcast(quality), "votes", "left")
