"""Temperature mixing of sources.

The token shares of the sources are raised to an exponent between 1 (as they are) and 0 (all alike). The
exponent is bisected to the largest at which the entropy of the weights reaches a target, unless a
limit on repetitions stops it earlier. The weights are realised with a token budget: the blocks of a
source are permuted anew for every epoch and taken until its quota is met.

Every aggregate is one of Spark's; the driver sees sums over the sources, never the sources.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import written

#: Halvings per job: one job measures all exponents that so many halvings can ask for.
LEVELS = 5


def token_estimate(text: str) -> Column:
    """A quarter of the UTF-8 bytes, at least 1."""
    return F.greatest(F.ceil(F.octet_length(F.coalesce(F.col(text), F.lit(""))) / 4), F.lit(1)).cast("long")


@dataclass(frozen=True)
class Shares:
    """Totals over the sources; `sums` measures sum(p^a) and sum(p^a ln p) for many exponents in one job."""

    n: int
    tokens: float
    largest: float
    smallest: float
    sums: Callable[[list[float]], list[tuple[float, float]]]

    def entropy(self, exponents: list[float]) -> list[float]:
        return [math.log(z) - a * s / z for a, (z, s) in zip(exponents, self.sums(exponents), strict=True)]

    def repeats(self, exponents: list[float], budget: float | None) -> list[float]:
        """How often the smallest source is read, the most of all."""
        if budget is None:
            return [(self.largest / self.smallest) ** (1 - a) for a in exponents]
        return [budget / self.tokens * self.smallest ** (a - 1) / z for a, (z, _) in zip(exponents, self.sums(exponents), strict=True)]


def shares_of(sources: DataFrame) -> Shares:
    """Totals of a table with a row per source and its `tokens`."""
    total = sources.agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.max("tokens").alias("a"), F.min("tokens").alias("z")).first()
    tokens = float(total["t"] or 1)
    share = F.col("tokens") / tokens

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        powers = [F.pow(share, F.lit(a)) for a in exponents]
        row = sources.agg(*(F.sum(x) for x in powers), *(F.sum(x * F.log(share)) for x in powers)).first()
        return list(zip(row[: len(exponents)], row[len(exponents) :], strict=True))

    return Shares(total["n"], tokens, (total["a"] or 1) / tokens, (total["z"] or 1) / tokens, sums)


def bisect(holds: Callable[[list[float]], list[bool]], rounds: int = 30) -> tuple[float, float]:
    """Bounds (low, high) of the place in 0 to 1 where `holds` turns from True to False.

    Bisection, `LEVELS` halvings to a call: the call gets every point that they could ask for.
    Both bounds are 1 if it holds at 1, and 0 if it fails at 0.
    """
    at_0, at_1 = holds([0.0, 1.0])
    if at_1 or not at_0:
        return (1.0, 1.0) if at_1 else (0.0, 0.0)
    low, high = 0.0, 1.0
    for _ in range(-(-rounds // LEVELS)):
        steps = 2**LEVELS
        points = [low + (high - low) * i / steps for i in range(1, steps)]
        known = [True, *holds(points), False]
        ends, i, width = [low, *points, high], 0, steps
        for _ in range(LEVELS):
            width //= 2
            i += width if known[i + width] else 0
        low, high = ends[i], ends[i + 1]
    return low, high


def exponent(shares: Shares, target_entropy: float, max_repeats: float, budget: float | None) -> float:
    """The largest exponent whose entropy is `target_entropy` (share of the most possible) or more,
    or if that repeats a source more than `max_repeats` times, the smallest that does not."""
    if shares.n < 2:
        return 1.0
    goal = target_entropy * math.log(shares.n) - 1e-12
    by_entropy = bisect(lambda a: [h >= goal for h in shares.entropy(a)])[0]
    by_repeats = bisect(lambda a: [r > max_repeats for r in shares.repeats(a, budget)])[1]
    return max(by_entropy, by_repeats)


def mix(
    docs: DataFrame,
    target_entropy: float = 0.97,
    max_repeats: float = 3.0,
    budget: float | None = None,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
    blocks: int = 4096,
    seed: int = 0,
) -> DataFrame:
    """`docs` mixed to the weights: rows repeated by epoch, with mix_tokens, mix_epoch and mix_position.

    `budget` tokens are dealt to the sources by weight; None is the smallest budget that gives every
    source all its rows once, so none is lost. Sorted by `mix_position` (0 to 1) every prefix has
    about the target weights. A source's rows lie in up to `blocks` blocks by hash; whole blocks are
    taken, so a quota is met to within half a block. Ranked together are only the blocks of one
    source and epoch. A row meets its block by source and block, so the largest source is spread
    over `blocks` groups.

    A null source is a source of its own. Null and empty texts count one token; repeated rows are
    dealt like others, equal ones in the same block. Texts are counted
    whole. An empty table gives no rows. Columns of the result's names are replaced, others stay, whatever their names.
    """
    name = F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    placed = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        name.alias("_source"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col(text)), F.lit(blocks)).cast("int").alias("_block"),
        token_estimate(text).alias("mix_tokens"),
    )
    sums = written(placed.groupBy("_source", "_block").agg(F.sum("mix_tokens").alias("n")), "blocks")
    sources = written(sums.groupBy("_source").agg(F.sum("n").alias("tokens")), "sources")
    shares = shares_of(sources)
    a = exponent(shares, target_entropy, max_repeats, budget)
    (z, _), *_ = shares.sums([a]) if shares.n else [(1.0, 0.0)]
    whole = budget if budget is not None else shares.tokens * z * shares.largest ** (1 - a)

    share = F.col("tokens") / shares.tokens
    repeats = (F.pow(share, F.lit(a)) / z * whole / F.col("tokens")).alias("repeats")
    read = sums.join(sources.select("_source", "tokens", repeats), "_source")
    last = F.ceil(F.col("repeats") - 1e-9).cast("int") - 1
    epochs = read.filter("repeats > 0").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))))
    draw = F.xxhash64(F.lit(seed), "_source", "mix_epoch", "_block")
    order = Window.partitionBy("_source", "mix_epoch").orderBy(draw, "_block")
    before = F.sum("n").over(order) - F.col("n")
    plan = epochs.withColumn("before", before + F.col("mix_epoch") * F.col("tokens"))
    quota = F.col("repeats") * F.col("tokens")
    plan = plan.filter(F.col("before") + F.col("n") / 2 <= quota * (1 + 1e-9))
    plan = plan.select("_source", "_block", "mix_epoch", (F.col("before") / quota).alias("mix_position"))
    new = ("mix_tokens", "mix_epoch", "mix_position")
    met = placed.join(plan, ["_source", "_block"])
    return met.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in new), *new)
