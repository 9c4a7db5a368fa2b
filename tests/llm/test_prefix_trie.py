from __future__ import annotations

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from haulmark.llm import prefix_trie
from haulmark.llm.common import written
from haulmark.llm.queries import ORACLE, op11_burst_trie
from oracle_check import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string"


def _rebuilt(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def _trie(convs):
    """The nodes by loops over all prefixes."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            node = nodes.setdefault(tuple(turns[:d]), ([], [], set()))
            node[0].append(c)
            if d == len(turns):
                node[1].append(c)
            else:
                node[2].add(turns[d])
    result, sums = [], {}
    for prefix in sorted(nodes, key=len, reverse=True):
        members, ends, children = nodes[prefix]
        below = [sums[(*prefix, x)] for x in children]
        leaves = sum(x[0] for x in below) if below else 1
        saved = sum(x[1] for x in below) + ((len(members) - 1) * len(prefix[-1][1].encode()) if prefix else 0)
        sums[prefix] = leaves, saved
        digest = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()
        parent = min(nodes[prefix[:-1]][0]) if prefix else None
        result.append((min(members), len(prefix), parent, len(members), len(children), leaves, saved, digest))
    return sorted(result, key=lambda r: r[:2])


def _built(spark, rows, limit, reach, schema=SCHEMA):
    turns = written(prefix_trie.numbered_turns(spark.createDataFrame(rows, schema)), "numbered")
    base, shared = F.expr("conv_id - conv_id % 5"), F.expr("crc32(cast(conv_id as string)) % 9")
    nodes = prefix_trie.prefix_trie(*prefix_trie.branched(turns, base, shared, 8), limit=limit, reach=reach)
    return sorted((tuple(x[c] for c in prefix_trie._COLUMNS) for x in nodes.collect()), key=lambda r: r[:2])


def _fixture(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(-6, 40):
        for t in range(rng.choice([1, 2, 3, 5, 9, 12, 14])):
            role = rng.choice(["u", "a", None]) if t > 9 else "u"
            text = rng.choice(["x", "é", None]) if t > 8 else "x" if rng.random() < 0.9 else "some longer text"
            rows.append((c, rng.choice([None, t, t]), role, text))
    rows += [(None, 1, "u", "x")] + [(100, 1, "u", "x")] * 20  # no conversation; repeated rows
    rows += [(c, t, "u", "x") for c in (201, 203, 204, 206) for t in range(20)]  # copies
    return rows


# containers that burst at once, slabs of a few turns, both, and neither
@pytest.mark.parametrize(("limit", "reach"), [(2, 1000), (1000, 4), (1, 5), (1000, 1000)])
def test_against_brute_force(spark, limit, reach):
    rows = _fixture(limit + reach)
    assert _built(spark, rows, limit, reach) == _trie(_rebuilt(rows))


def test_ranks_of_a_conversation_over_many_partitions(spark):
    rows = [(7, t, "u", f"text {t % 13}") for t in range(3000)] + [(8, None, None, None), (8, None, None, None)]
    found = prefix_trie.numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(8))
    ranks = sorted(r["rank"] for r in found.filter("conv_id = 7").collect())
    assert ranks == list(range(1, 3001))
    assert sorted(tuple(r)[:2] + (r["size"],) for r in found.filter("conv_id = 8").collect()) == [(8, 1, 0), (8, 2, 0)]


def test_very_long_texts_turnless_conversations_clashing_columns_and_empty_table(spark):
    long = "word " * 200_000
    clash = "conv_id long, turn long, role string, text string, rank int, part string, box int, head string"
    rows = [(5, 1, "u", long), (10, 1, "u", long), (10, 2, "a", None), (11, 3, None, "x")]
    got = _built(spark, [(*r, 1, "p", 2, "h") for r in rows], 1, 2, clash)
    assert got == _trie(_rebuilt(rows))
    assert _built(spark, [], 1, 2) == []
    assert _built(spark, [(None, 1, "u", "x")], 1, 2) == []


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    with connect(sf) as connection:
        assert differences(op11_burst_trie(spark, sf), connection, ORACLE["op11_burst_trie"]) == []
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = sorted((tuple(x[c] for c in prefix_trie._COLUMNS) for x in op11_burst_trie(spark, sf).collect()), key=lambda r: r[:2])
    assert got == _trie(_rebuilt(rows))
