"""Removal of repeated runs of lines, by winnowing over line hashes.

The lines of a text that hold a word are laid out along its words. A gram is the shortest run of
lines from a line on that covers `gram` words, and its hash is one over its lines' hashes. Of the
grams that begin within `window` words the one with the least hash is selected. What is selected
depends on the lines alone, so every run of at least `gram + window - 1` words that occurs twice
has a selected gram at the same place of both occurrences.

Each selected gram is joined with its first occurrence and the match extended line by line both ways
until the lines differ or a text ends. A gram brings the lines near it along, which is all that most
matches need, since the next gram of the run carries on: matches on one diagonal (two texts and the distance of
their lines) are put together. Where a match reaches the end of the lines it brought and lines of the
text beyond it would stay, it is carried on strip by strip, the two texts' strips of lines joined by
number, until it ends. The lines of the later occurrence are deleted. Every deleted line has an
equal line earlier, so one copy of each stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.common import WORD, written

#: Lines of a strip.
STRIP = 64

#: Bits of a row of a bitmap, bits for each entry, and bits in all at most (16 MB).
MAP, BITS, MOST_BITS = 2**15, 16, 2**27


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _text, line, h, words) of the lines with a word; copies of a row are one text."""
    each = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_text"), F.posexplode(F.split(text, "\n")).alias("line", "_s"))
    each = each.select("_key", "_text", "line", F.xxhash64("_s").alias("h"), F.regexp_count("_s", F.lit(WORD)).alias("words"))
    return each.filter("words > 0").repartition("_key", "_text").dropDuplicates(["_key", "_text", "line"])


def fingerprints(lines: DataFrame, gram: int, window: int) -> DataFrame:
    """Selected grams of `_lines`: g, _key, _text, line, its rank among the text's lines with a word, the first and last of
    these, and the near ones before and from there as (line, h)."""
    reach = gram + window - 1
    of_text = Window.partitionBy("_key", "_text")
    before = F.coalesce(F.sum("words").over(of_text.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # with the words of a line counted up to `gram`, grams stay the same and end within 2 * gram - 1
    short = F.sum(F.least("words", F.lit(gram))).over(of_text.orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumns({"start": before.cast("long"), "place": F.coalesce(short, F.lit(0)).cast("long")})
    ranked = of_text.orderBy("line")
    lines = lines.withColumns({"rank": F.row_number().over(ranked), "top": F.min("line").over(of_text), "bottom": F.max("line").over(of_text)})
    along = of_text.orderBy("start")
    here = F.struct("line", "h", "start", (F.col("start") + F.col("words")).alias("end"))
    lines = lines.withColumn("ahead", F.collect_list(here).over(of_text.orderBy("place").rangeBetween(0, 2 * gram + reach - 2)))
    lines = lines.withColumn("behind", F.collect_list(here).over(along.rangeBetween(-reach, -1)))
    # the lines of the gram begin before it has all its words; it is whole if it gets them
    own = F.filter("ahead", lambda x, i: (i == 0) | (F.element_at("ahead", F.greatest(i, F.lit(1)))["end"] < F.col("start") + gram))
    lines = lines.withColumn("own", own).withColumn("end", F.element_at("own", -1)["end"])
    whole = F.col("end") >= F.col("start") + gram
    lines = lines.withColumn("g", F.when(whole, F.xxhash64(F.transform("own", lambda x: x["h"]))))
    least = F.min(F.when(F.col("g").isNotNull(), F.struct("g", "line"))).over(along.rangeBetween(0, window - 1))
    lines = lines.withColumn("least", least["line"])
    chosen = F.collect_list("least").over(along.rangeBetween(1 - window, 0))
    lines = lines.withColumn("selected", F.array_contains(chosen, F.col("line")))

    def slim(column: str) -> Column:
        # at most reach - 1 words follow the last selected gram of a run, so its last line begins by then
        near = F.filter(column, lambda x: x["start"] <= F.greatest(F.col("end") - 2, F.col("start")) + reach)
        return F.transform(near, lambda x: F.struct(x["line"], x["h"])).alias(column)

    return lines.filter("selected and g is not null").select(
        "g", "_key", "_text", "line", "rank", "top", "bottom", slim("behind"), slim("ahead")
    )


def _agreeing(a: Column, b: Column) -> Column:
    """Number of leading lines that are equal."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x["h"].eqNullSafe(y["h"])), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("int")


def _islands(rows: DataFrame, by: list[str], begin: str, end: str) -> DataFrame:
    """Adds `_island`, the same for rows of one group whose spans overlap or adjoin."""
    along = Window.partitionBy(*by).orderBy(begin, end)
    before = F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col(begin) > before + 1).cast("int"), F.lit(0))
    return rows.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(along)).drop("_opens")


_PAIR = ["_key", "_text", "_first_key", "_first_text", "shift"]


def _matches(marks: DataFrame) -> DataFrame:
    """Matches of grams with their first occurrence, put together on each diagonal.

    Result: the two texts, `shift` (of the ranks), first and last rank and line in the later text,
    `stops_back` and `stops_forth` (the line there is the last that agrees), and whether lines that would stay lie
    beyond them (`open_back`, `open_forth`).
    """
    place = F.struct("_key", "_text", "line", "rank", "behind", "ahead")
    firsts = marks.groupBy("g").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("g", "first")
    both = marks.join(written(firsts, "firsts"), "g")
    same = (
        F.col("_key").eqNullSafe(F.col("first._key")) & (F.col("_text") == F.col("first._text")) & (F.col("line") == F.col("first.line"))
    )
    forth = F.greatest(_agreeing(F.col("ahead"), F.col("first.ahead")), F.lit(1))
    back = _agreeing(F.reverse("behind"), F.reverse("first.behind"))
    runs = both.filter(~same).select(
        "_key", "_text", F.col("first._key").alias("_first_key"), F.col("first._text").alias("_first_text"),
        (F.col("rank") - F.col("first.rank")).alias("shift"), "top", "bottom",
        (F.col("rank") - back).alias("from_rank"), (F.col("rank") + forth - 1).alias("to_rank"),
        F.when(back > 0, F.element_at("behind", F.least(-back, F.lit(-1)))["line"]).otherwise(F.col("line")).alias("from"),
        F.element_at("ahead", forth)["line"].alias("to"),
        (back < F.least(F.size("behind"), F.size("first.behind"))).alias("stops_back"),
        (forth < F.least(F.size("ahead"), F.size("first.ahead"))).alias("stops_forth"),
    )
    joined = _islands(runs, _PAIR, "from_rank", "to_rank").groupBy(*_PAIR, "_island").agg(
        F.min("top").alias("top"), F.max("bottom").alias("bottom"),
        F.min("from_rank").alias("from_rank"), F.max("to_rank").alias("to_rank"), F.min("from").alias("from"), F.max("to").alias("to"),
        # one match that met a difference there is enough to know
        F.max(F.struct(-F.col("from_rank"), F.col("stops_back").alias("stops")))["stops"].alias("stops_back"),
        F.max(F.struct("to_rank", F.col("stops_forth").alias("stops")))["stops"].alias("stops_forth"),
    ).drop("_island")
    covered = Window.partitionBy("_key", "_text", "_island")
    return _islands(joined, ["_key", "_text"], "from", "to").select(
        *joined.columns,
        (F.min("from").over(covered) > F.col("top")).alias("open_back"),
        (F.max("to").over(covered) < F.col("bottom")).alias("open_forth"),
    )


def _strips(lines: DataFrame, ends: DataFrame) -> DataFrame:
    """(_key, _text, strip, first, lines) of the texts in `ends`: each strip's lines with a word, and those of its neighbours, from rank `first` on."""
    names = ends.select("_key", "_text").unionByName(ends.select(F.col("_first_key").alias("_key"), F.col("_first_text").alias("_text"))).distinct()
    names = written(names.select(F.col("_key").alias("k"), F.col("_text").alias("t")), "open")
    lines = lines.join(names, F.col("_key").eqNullSafe(F.col("k")) & (F.col("_text") == F.col("t")), "left_semi")
    lines = lines.withColumn("rank", F.row_number().over(Window.partitionBy("_key", "_text").orderBy("line")))
    own = F.floor(F.col("rank") / STRIP)
    lines = lines.withColumn("strip", F.explode(F.array(own - 1, own, own + 1)))
    strips = lines.groupBy("_key", "_text", "strip").agg(F.sort_array(F.collect_list(F.struct("rank", "line", "h"))).alias("lines"))
    return strips.withColumn("first", F.element_at("lines", 1)["rank"])


def _carried_on(lines: DataFrame, matches: DataFrame) -> list[DataFrame]:
    """Spans (_key, _text, from, to) that the open ends of `matches` add, a table for each round of strips."""
    forth = matches.filter("open_forth and not stops_forth").select(*_PAIR, F.col("to_rank").alias("at"), F.col("to").alias("line"), F.lit(1).alias("step"))
    back = matches.filter("open_back and not stops_back").select(*_PAIR, F.col("from_rank").alias("at"), F.col("from").alias("line"), F.lit(-1).alias("step"))
    ends, spans = written(forth.unionByName(back), "ends"), []
    if ends.isEmpty():
        return spans
    strips = written(_strips(lines, ends), "strips")
    while not ends.isEmpty():
        next_rank = F.col("at") + F.col("step")
        place = ends.withColumns({"_strip": F.floor(next_rank / STRIP), "_first_strip": F.floor((next_rank - F.col("shift")) / STRIP)})

        def side(names: tuple[str, str, str], lines: str, first: str) -> tuple[DataFrame, Column]:
            other = strips.select(F.col("_key").alias("k"), F.col("_text").alias("t"), F.col("strip").alias("s"), F.col("lines").alias(lines), F.col("first").alias(first))
            return other, F.col(names[0]).eqNullSafe(F.col("k")) & (F.col(names[1]) == F.col("t")) & (F.col(names[2]) == F.col("s"))

        table, met = side(("_key", "_text", "_strip"), "own", "own_first")
        place = place.join(table, met).drop("k", "t", "s")
        # never broadcast: in memory the strips are over ten times their files, by which Spark sizes them
        table, met = side(("_first_key", "_first_text", "_first_strip"), "other", "other_first")
        place = place.join(table.hint("merge"), met).drop("k", "t", "s")

        def next_lines(lines: str, first: str, rank: Column) -> Column:
            """Up to a strip's number of lines from `rank` on, in the direction of the step."""
            at = (rank - F.col(first) + 1).cast("int")
            up = F.slice(lines, F.greatest(at, F.lit(1)), F.when(at > 0, STRIP).otherwise(0))
            low = F.greatest(at - STRIP + 1, F.lit(1))
            return F.when(F.col("step") > 0, up).otherwise(F.reverse(F.slice(lines, low, F.greatest(at - low + 1, F.lit(0)))))

        place = place.withColumns({"a": next_lines("own", "own_first", next_rank), "b": next_lines("other", "other_first", next_rank - F.col("shift"))})
        place = place.withColumn("n", _agreeing(F.col("a"), F.col("b")))
        moved = place.filter("n > 0").select(
            *_PAIR, (F.col("at") + F.col("step") * F.col("n")).alias("at"), F.element_at("a", F.greatest("n", F.lit(1)))["line"].alias("line"), "step",
            F.col("line").alias("before"), (F.col("n") == STRIP).alias("more"),
        )
        moved = written(moved, "ends")
        spans.append(moved.select("_key", "_text", F.least("before", "line").alias("from"), F.greatest("before", "line").alias("to")))
        ends = moved.filter("more").drop("before", "more")
    return spans


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", gram: int = 25, window: int = 26) -> DataFrame:
    """(_key, _text, runs): places (from, to) of the lines that repeat earlier ones, by row and text hash.

    Earlier means: smaller key (null first), then smaller hash of the text, then smaller line. A
    gram that very many texts share meets one row, its first occurrence; the join's sides are
    written tables straight from a shuffle, so Spark splits such a gram.
    """
    lines = written(_lines(docs, key, text), "lines")
    marks = written(fingerprints(lines, gram, window), "marks")
    matches = written(_matches(marks), "matches")
    runs = matches.select("_key", "_text", "from", "to")
    for more in _carried_on(lines, matches):
        runs = runs.unionByName(more)
    return runs.groupBy("_key", "_text").agg(F.collect_set(F.struct("from", "to")).alias("runs"))


def _bitmap(hashes: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(_map, bits) of the `n` rows' column `h`, each setting one bit, and the number of bits; a full map says less, but never no to an entry."""
    bits = min(MOST_BITS, -(-n * BITS // MAP) * MAP or MAP)
    bit = F.pmod("h", F.lit(bits))
    placed = hashes.select(F.floor(bit / MAP).alias("_map"), (bit % MAP).alias("_bit"))
    return placed.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("bits")), bits


def _split_by(rows: DataFrame, h: str, bitmap: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose hash `h` may be an entry of the bitmap, and those whose is none; nothing is shuffled."""
    bit = F.pmod(h, F.lit(bits))
    met = rows.withColumn("_at", F.floor(bit / MAP)).join(F.broadcast(bitmap), F.col("_at") == F.col("_map"), "left")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit % MAP / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.expr("shiftright(_byte, _shift) % 2 = 1"), F.lit(False))
    met = met.withColumns({"_byte": byte, "_shift": (bit % 8).cast("int")}).withColumn("_set", is_set)
    return met.filter("_set").select(*rows.columns), met.filter("not _set").select(*rows.columns)


def remove_repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", gram: int = 25, window: int = 26) -> DataFrame:
    """`docs` with `text` less the repeated runs, and `n_lines` and `n_removed`, its lines before and gone.

    Lines between the lines of a run that hold no word go with it; the others stay as they are, in
    order. Rows equal in key and text are one text and get the same result each. Null texts stay
    null with no lines; empty ones have one line; an empty table gives no rows. Texts of any length are
    worked on line by line, and matches followed to their ends. Columns named `n_lines` or `n_removed` are
    replaced, other columns stay, whatever their names. Only texts that may hold a repeated run, by a bitmap
    of those that do, are shuffled to meet their runs.
    """
    runs = repeated_runs(docs, key, text, gram, window).select(F.col("_key").alias("k"), F.col("_text").alias("t"), "runs")
    runs = written(runs, "runs")
    bitmap, bits = _bitmap(runs.select(F.xxhash64("k", "t").alias("h")), runs.count())
    met = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[key].alias("key"), F.xxhash64(docs[text]).alias("hash"))
    some, none = _split_by(met.withColumn("h", F.xxhash64("key", "hash")), "h", written(bitmap, "bitmap"), bits)
    met = some.join(runs, F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("t")), "left")
    met = met.unionByName(none, allowMissingColumns=True)
    met = met.withColumn("text", F.col("row")[text])
    gone = F.flatten(F.transform("runs", lambda r: F.sequence(r["from"], r["to"])))
    met = met.withColumn("lines", F.split("text", "\n"))
    met = met.withColumn("left", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone))
    cut = F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    n_removed = F.when(F.col("runs").isNull(), 0).otherwise(F.size("lines") - F.size("left")).cast("long")
    made = {text: F.when(F.col("runs").isNull(), F.col("text")).otherwise(cut), "n_lines": n_lines, "n_removed": n_removed}
    names = [*docs.columns, *(c for c in ("n_lines", "n_removed") if c not in docs.columns)]
    return met.select(*(made.get(c, F.col("row")[c]).alias(c) for c in names))
