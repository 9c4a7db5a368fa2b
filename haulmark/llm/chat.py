r"""Conversations formatted into windows of a token budget.

Template, one piece per turn: `### role: text</turn>` and a line feed. Control strings cannot
occur inside roles and texts: a backslash is doubled, `###` and `</turn>` are broken by a
backslash, and in roles one stands before each colon. Every backslash of the escaped form is thus an escape; dropping it
gives the original back.

Windows: prefix sums over the tokens of a conversation's turns choose spans that begin and end
between turns. A window repeats the system turn and a limited number of the turns before it, and its
loss mask covers the assistant texts that are new in it, so each is trained on once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import ranked, written

END = "</turn>"
MARK = "###"


def escape(text: Column) -> Column:
    """Text in which no control string occurs."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.regexp_replace(text, "#(?=##)", "#\\\\")
    return F.replace(text, F.lit(END), F.lit("<\\/turn>"))


def escape_role(role: Column) -> Column:
    """As `escape`, and every colon is escaped."""
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def unescape(text: Column) -> Column:
    """The original of an escaped text or role."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def token_count(text: Column) -> Column:
    """Words and punctuation marks, and four for the marks of the turn."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]")) + 4


#: A turn as it is carried along.
ROW = "struct<turn:bigint,role:string,text:string,tokens:int>"


def format_conversations(
    turns: DataFrame,
    budget: int = 512,
    history: int = 128,
    history_turns: int = 4,
    part_turns: int = 512,
) -> DataFrame:
    """Windows of the conversations in `turns` (conv_id, turn, role, text).

    Result: conv_id, part, window (in this order they follow each other), formatted, n_repeated
    (leading pieces that repeat earlier turns), n_new, loss (array of start and end, code points
    in `formatted`, end exclusive) and tokens. A window holds at most `budget` tokens unless one
    turn with its repeated system turn and history is larger; turns are never cut. History is
    the longest run of the last `history_turns` turns that fits `history` tokens.

    A conversation is worked on in parts of `part_turns` turns, one after another, so that no row holds more of
    it. A part hands its open span, the turns before it and the system turn on to the next. So the
    windows do not depend on the parts; only the part in which a window was closed is told by `part`.

    Turns follow their number (null first), then role, then text; repeated rows stay repeated.
    Null roles and texts are empty; a null conv_id is one conversation. Texts of any length stay whole. Other
    columns are ignored; an empty table gives no windows.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("role", "text"))
    rows = ranked(turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text), "conv_id", ["turn", "role", "text"])
    row = F.struct("turn", "role", "text", token_count(F.col("text")).alias("tokens"))
    part = F.floor((F.col("rank") - 1) / part_turns).alias("part")
    of_part = F.sort_array(F.collect_list(F.struct("rank", row.alias("row"))))
    parts = rows.groupBy("conv_id", part).agg(F.transform(of_part, lambda x: x["row"]).alias("rows"))
    parts = written(parts, "parts")
    ends = parts.groupBy(F.col("conv_id").alias("_conv")).agg(F.max("part").alias("_last"))
    ends = written(ends.filter("_last > 0"), "long")
    last = ends.agg(F.max("_last")).first()[0] or 0
    none, no_rows = F.lit(None).cast(ROW), F.array().cast(f"array<{ROW}>")
    state, found = None, []
    for number in range(last + 1):
        now = parts.filter(F.col("part") == number)
        if last:
            now = now.join(ends, now["conv_id"].eqNullSafe(F.col("_conv")), "left").drop("_conv")
        ended = F.col("part") == F.coalesce("_last", F.lit(0)) if last else F.lit(True)
        now = now.withColumn("ended", ended)
        if state is None:
            now = now.withColumns({"fresh": F.lit(True), "tail": no_rows, "system": none})
        else:
            carried = state.withColumnsRenamed({"conv_id": "_conv", "rows": "_open"})
            now = now.join(carried, now["conv_id"].eqNullSafe(F.col("_conv"))).withColumn("rows", F.concat("_open", "rows"))
        now = now.select("conv_id", "part", "ended", "rows", "fresh", "tail", "system")
        now = now.withColumn("done", _spans(budget, history, history_turns))
        if number < last:
            now = written(now, "spans")
            span = F.element_at("done.spans", -1)
            state = now.filter(~F.col("ended")).select(
                "conv_id", F.slice("rows", span["first"], span["n"]).alias("rows"), (F.col("fresh") & (F.size("done.spans") == 1)).alias("fresh"),
                span["tail"].alias("tail"), span["system"].alias("system"),
            )
            state = written(state, "state")
        closed = F.slice("done.spans", F.lit(1), F.size("done.spans") - F.when(F.col("ended"), 0).otherwise(1))
        found.append(now.select("conv_id", "part", "rows", F.posexplode(closed).alias("window", "span")))
    windows = reduce(DataFrame.unionByName, found)

    past = _fitting_suffix(F.col("span")["tail"], history)
    repeated = F.concat(F.filter(F.array(F.col("span")["system"]), lambda r: r.isNotNull()), past)
    windows = windows.withColumn("repeated", repeated).withColumn("new", F.slice("rows", F.col("span")["first"], F.col("span")["n"]))
    pieces = F.transform(
        F.concat("repeated", "new"),
        lambda r: F.struct(
            F.concat(F.lit(f"{MARK} "), escape_role(r["role"]), F.lit(": ")).alias("head"),
            escape(r["text"]).alias("body"),
            (r["role"] == "assistant").alias("learn"),
            r["tokens"].alias("tokens"),
        ),
    )
    windows = windows.withColumn("pieces", pieces)
    total = F.aggregate("pieces", F.lit(0), lambda n, p: n + p["tokens"])
    return windows.select(
        "conv_id",
        "part",
        "window",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(f"{END}\n"))), "").alias("formatted"),
        F.size("repeated").alias("n_repeated"),
        F.size("new").alias("n_new"),
        _loss_spans(F.col("pieces"), F.size("repeated")).alias("loss"),
        total.alias("tokens"),
    )


def _spans(budget: int, history: int, history_turns: int) -> Column:
    """Spans (first, n, tail, system) of `rows`: a turn opens a new span when the prefix sum leaves the span's room.

    `tail` are the last turns before a span that are no system turns, `system` the first system turn before
    it. The room is `budget` less the history and the system turn, in a conversation's first span
    (`fresh`) all of it. Those of the first span here, and whether it is fresh, come from the columns.
    """
    spans = f"array<struct<first:int,n:int,tail:array<{ROW}>,system:{ROW}>>"

    def closed(acc: Column, n: Column) -> Column:
        span = F.struct(acc["first"].alias("first"), n.alias("n"), acc["span_tail"].alias("tail"), acc["span_system"].alias("system"))
        return F.concat(acc["spans"], F.array(span))

    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("floor"),
        F.array().cast(spans).alias("spans"),
        F.lit(1).alias("first"),
        F.col("tail").alias("span_tail"),
        F.col("system").alias("span_system"),
        F.col("tail").alias("tail"),
        F.col("system").alias("system"),
    )

    def step(acc: Column, row: Column) -> Column:
        end = acc["prefix"] + row["tokens"]
        room = F.greatest(F.lit(budget - history) - F.coalesce(acc["span_system"]["tokens"], F.lit(0)), F.lit(1))
        room = F.when((F.size(acc["spans"]) == 0) & F.col("fresh"), F.lit(budget)).otherwise(room)
        full = (acc["at"] + 1 > acc["first"]) & (end - acc["floor"] > room)
        is_system = row["role"] == "system"
        longer = F.concat(acc["tail"], F.array(row))
        kept = F.slice(longer, F.greatest(F.size(longer) - history_turns + 1, F.lit(1)), history_turns)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            end.alias("prefix"),
            F.when(full, acc["prefix"]).otherwise(acc["floor"]).alias("floor"),
            F.when(full, closed(acc, acc["at"] + 1 - acc["first"])).otherwise(acc["spans"]).alias("spans"),
            F.when(full, acc["at"] + 1).otherwise(acc["first"]).alias("first"),
            F.when(full, acc["tail"]).otherwise(acc["span_tail"]).alias("span_tail"),
            F.when(full, acc["system"]).otherwise(acc["span_system"]).alias("span_system"),
            F.when(is_system, acc["tail"]).otherwise(kept).alias("tail"),
            F.when(acc["system"].isNull() & is_system, row).otherwise(acc["system"]).alias("system"),
        )

    def finish(acc: Column) -> Column:
        return F.struct(closed(acc, acc["at"] - acc["first"] + 1).alias("spans"))

    return F.aggregate("rows", start, step, finish)


def _fitting_suffix(rows: Column, tokens: int) -> Column:
    """The longest suffix of at most `tokens` tokens."""
    empty = F.slice(rows, 1, 0)

    def step(acc: Column, row: Column) -> Column:
        total = acc["total"] + row["tokens"]
        fits = acc["open"] & (total <= tokens)
        return F.struct(
            total.alias("total"),
            fits.alias("open"),
            F.when(fits, F.concat(F.array(row), acc["kept"])).otherwise(acc["kept"]).alias("kept"),
        )

    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(True).alias("open"), empty.alias("kept"))
    return F.aggregate(F.reverse(rows), start, step, lambda acc: acc["kept"])


def _loss_spans(pieces: Column, n_repeated: Column) -> Column:
    """Places of the bodies of the assistant's pieces behind the repeated ones."""
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit(0).cast("long").alias("offset"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"),
    )

    def step(acc: Column, p: Column) -> Column:
        begin = acc["offset"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        learn = p["learn"] & (acc["at"] >= n_repeated)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            (end + len(END) + 1).alias("offset"),
            F.when(learn, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, start, step, lambda acc: acc["spans"])


def read_back(windows: DataFrame) -> DataFrame:
    """Adds to each window `turns` (role and text of the new turns) and `loss_text` (unescaped)."""
    pieces = F.split("formatted", f"{END}\n")
    new = F.slice(pieces, F.col("n_repeated") + 1, F.col("n_new"))

    def parsed(piece: Column) -> Column:
        role = F.regexp_extract(piece, rf"^{MARK} ((?:[^:\\]++|(?s:\\.))*+): ", 1)
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substr(piece, F.length(role) + len(MARK) + 4)).alias("text"),
        )

    masked = F.transform(
        "loss", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return windows.withColumn("turns", F.transform(new, parsed)).withColumn("loss_text", F.array_join(masked, ""))
