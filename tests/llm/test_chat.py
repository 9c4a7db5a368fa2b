from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from haulmark.llm import chat
from haulmark.llm.queries import ODD_TURN, op1_chat_windows

SCHEMA = "conv_id bigint, turn bigint, role string, text string, window int, part string"
ODD = ["\\", "###", "####", "\\###", "</turn>", "<\\/turn>", ": ", "\n", "</turn>\n### user: ", ODD_TURN, "", "é🙂", "#", "<"]


def _digests(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _read(windows):
    ends = F.sort_array(F.collect_list(F.struct(F.coalesce("part", F.lit(-99)), "window", "turns", "loss_text")))
    got = {}
    for row in chat.read_back(windows).groupBy("conv_id").agg(ends.alias("w")).collect():
        turns = [t for w in row["w"] for t in w["turns"]]
        said = "".join(f"{t['role']}\n{t['text']}\n" for t in turns)
        loss = "".join(w["loss_text"] for w in row["w"])
        got[row["conv_id"]] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return got


def test_query_reads_back_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", ODD_TURN), (-7, 1, "assistant", ODD_TURN)]
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in op1_chat_windows(spark, sf).collect()}
    assert got == _digests(rows)


@pytest.mark.parametrize("part_turns", [3, 256])
def test_odd_texts_nulls_ties_and_long_conversations(spark, part_turns):
    rng = random.Random(1)
    text = lambda: rng.choice([None, *("".join(rng.choices([*ODD, "word "], k=rng.randint(0, 6))) for _ in range(20))])
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd: role", "x:"]), text()) for c in [1, 2, None] for t in [*range(20), None, 4, 4]]
    rows += rows[:3]
    rows.append((9, 0, "assistant", "word " * 5000))
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)
    windows = chat.format_conversations(df, budget=30, history=10, history_turns=3, part_turns=part_turns)
    assert _read(windows) == _digests(rows)


def test_windows_keep_budget_system_and_history(spark):
    rows = [(1, 0, "system", "be brief", 0, "")]
    rows += [(1, t, "user" if t % 2 else "assistant", f"a{t} b c d", 0, "") for t in range(1, 40)]
    windows = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), budget=40, history=17, history_turns=4, part_turns=8)
    found = chat.read_back(windows).orderBy(F.coalesce("part", F.lit(-1)), "window").collect()
    at = 0
    for k, w in enumerate(found):
        assert w["tokens"] <= 40
        lines = w["formatted"].split("</turn>\n")[:-1]
        assert lines[0] == "### system: be brief"
        if k:
            assert w["n_repeated"] == 3  # the system turn and two of eight tokens each
            assert lines[1:3] == [f"### {r[2]}: {r[3]}" for r in rows[at - 2 : at]]
        at += w["n_new"]
        assert w["loss_text"] == "".join(t["text"] for t in w["turns"] if t["role"] == "assistant")
    assert at == len(rows)


@pytest.mark.parametrize("at", [0, 5])
def test_system_turn_of_the_first_part_counts(spark, at):
    rows = [(1, t, "system" if t == at else "user", f"a{t} b c d", 0, "") for t in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = chat.format_conversations(df, budget=40, history=16, history_turns=4).orderBy("window").collect()
    assert [w["tokens"] for w in found[1:-1]] == [40] * (len(found) - 2) and found[0]["tokens"] == 40
    assert sum(w["n_new"] for w in found) == 30 and all("### system" in w["formatted"] for w in found[1:])


def _windows(rows, budget, history, history_turns):
    """The windows of one conversation by a loop over all its turns: (tokens, repeated, new) with the turns of each."""
    cost = lambda r: len(re.findall(r"\w+|[^\w\s]", r[1])) + 4
    spans, first, used = [], 0, 0
    for at, row in enumerate(rows):
        system = next((r for r in rows[:first] if r[0] == "system"), None)
        room = budget if not spans else max(budget - history - (cost(system) if system else 0), 1)
        if at > first and used + cost(row) > room:
            spans.append((first, at))
            first, used = at, 0
        used += cost(row)
    spans.append((first, len(rows)))
    out = []
    for a, b in spans:
        system = [r for r in rows[:a] if r[0] == "system"][:1]
        past = []
        for r in reversed([r for r in rows[:a] if r[0] != "system"][-history_turns:]):
            if sum(map(cost, past)) + cost(r) > history:
                break
            past.insert(0, r)
        out.append(("".join(f"### {r}: {t}</turn>\n" for r, t in [*system, *past, *rows[a:b]]), len(system) + len(past), b - a))
    return out


@pytest.mark.parametrize("part_turns", [2, 7, 256, 100_000])
def test_windows_do_not_depend_on_the_parts(spark, part_turns):
    """Dense, sparse, null and repeated turn numbers; a system turn first, late, several, or none."""
    rng = random.Random(3)
    rows = []
    for conv, numbers in enumerate(([*range(30)], [*range(0, 9000, 300)], [None] * 25, [5] * 25, [None, 1, 1, 2, 700, 700, 701])):
        for n in numbers:
            rows.append((conv, n, rng.choice(["user", "assistant", "user", "assistant", "system"]), "word " * rng.randint(0, 9) + f"{len(rows)}"))
    rows += [(8, t, "user", "a b c d") for t in range(0, 2400, 300)]
    want = {}
    for conv in {r[0] for r in rows}:
        of = sorted((r[1] is not None, r[1] or 0, r[2], r[3]) for r in rows if r[0] == conv)
        want[conv] = _windows([r[2:] for r in of], 60, 20, 3)
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA).repartition(3)
    found = chat.format_conversations(df, budget=60, history=20, history_turns=3, part_turns=part_turns).orderBy("conv_id", "part", "window")
    got = {}
    for w in found.collect():
        got.setdefault(w["conv_id"], []).append((w["formatted"], w["n_repeated"], w["n_new"]))
    assert got == want


def test_plan_is_native(spark):
    plan = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "x", 0, "")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
