"""Prefix trie, running sums and list ranking against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemill.llm import scans
from tidemill.llm.conversation_trie import borrowed_starts, numbered_turns, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def lists(rows):
    """Conversations as lists of (role, text)."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            out[conv].append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    return {c: [(t[1], t[3]) for t in sorted(v)] for c, v in out.items()}


def borrowed(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
    rows = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(node))
        rows.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(kids), len(childless),
                     sum((len(members[n]) - 1) * words(n) for n in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=lambda r: (r[1], r[0]))


def made(spark, rows, rebuild):
    turns = numbered_turns(spark.createDataFrame(rows, SCHEMA).repartition(3))
    plain = turns, turns.groupBy("conv_id").agg(F.max("rank").alias("length"))
    found = prefix_trie(*(borrowed_starts(turns) if rebuild else plain))
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[1], r[0]))


@pytest.fixture(scope="module")
def odd_rows():
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "b c", "d\te  f"]))
            for c in range(70) for t in range(rnd.randrange(1, 6))]
    rows += [(c, t, "user", "same start") for c in range(100, 130) for t in range(2)]  # copies; some borrow from none
    rows += [(141, None, None, None), (141, None, "user", None), (141, 0, "user", ""), (141, 0, "user", ""), (None, 0, "user", "lost")]
    rows += [(150, k, "user", "w " * 50) for k in range(120)] + [(1 << 40, 0, "user", "x" * 200_000), (163, 0, "a", "gone")]
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
def test_nodes_equal_brute_force(spark, odd_rows, rebuild):
    convs = lists(odd_rows)
    convs = borrowed(convs) if rebuild else convs
    assert not rebuild or any(not t for t in convs.values())  # turnless ones count at the root
    assert made(spark, odd_rows, rebuild) == trie(convs)


def test_nodes_with_every_round_distributed(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(scans, "FEW", 40)
    rows = [r for r in odd_rows if r[0] is not None and r[0] < 20]
    assert made(spark, rows, True) == trie(borrowed(lists(rows)))


def test_no_conversations_no_nodes(spark):
    assert made(spark, [], True) == [] and made(spark, [(None, 1, "user", "x")], True) == []


def test_clashing_columns_are_left_out(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a")]
    names = ["rank", "x", "y", "words", "row", "text_md5", "part_", "at_"]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in names})
    found = prefix_trie(*borrowed_starts(numbered_turns(df)))
    assert [r.n_convs for r in found.orderBy("depth").collect()][0] == 2


@pytest.mark.parametrize("op", ["sum", "xor"])
def test_running_spans_partitions(spark, op):
    rnd = random.Random(6)
    rows = [(0 if i % 3 else rnd.randrange(20), i, rnd.randrange(-9, 1000)) for i in range(3000)]  # one key has two thirds
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(5)
    for key in ("k", None):
        order = ["k", "i"] if key else ["i"]
        found = {r.i: r.upto for r in scans.running(df, order, {"upto": "v"}, key, op).collect()}
        at, last = 0, None
        for k, i, v in sorted(rows, key=lambda r: r[:2] if key else r[1]):
            at = v if key and k != last else (at + v if op == "sum" else at ^ v)
            last = k
            assert found[i] == at
    assert scans.running(df.where("k < 0"), ["k", "i"], {"upto": "v"}, "k").count() == 0


def test_list_ranks(spark):
    for n, few in ((1, 10), (2, 1), (700, 30)):
        p = list(range(100, 100 + n))
        random.Random(n).shuffle(p)
        links = [(p[i], p[i - 1] if i else -1, p[i + 1] if i < n - 1 else -1) for i in range(n)]
        found = scans.list_ranks(spark.createDataFrame(links, "id long, prev long, next long"), max(few, 2)).collect()
        assert sorted((r.place, r.id) for r in found) == list(enumerate(p))
    assert scans.list_ranks(spark.createDataFrame([], "id long, prev long, next long")).count() == 0
