"""The trie of conversations against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tripspark.llm import prefix_trie


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain_turns(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            held[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    return {c: [t[3:] for t in sorted(own)] for c, own in held.items()}


def plain_rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def plain_nodes(convs):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
            if d:
                kids[tuple(own[:d - 1])].add(tuple(own[:d]))
        ends[tuple(own)].append(c)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in kids[path])
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
    return sorted((min(own), len(path), min(members[path[:-1]]) if path else None, len(own),
                   len(kids[path]), leaves[path], saved[path],
                   hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
                  for path, own in members.items())


def found(df):
    return sorted(tuple(r[c] for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256")) for r in df.collect())


KIND = "conv_id long, turn int, role string, text string"


def test_branching_conversations(spark, monkeypatch):
    """Few different turns, so that conversations part, end and continue everywhere."""
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    monkeypatch.setattr(prefix_trie, "COARSE", 2)
    monkeypatch.setattr(prefix_trie, "FINE", 1)
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "a b", ""]))
            for c in range(-30, 150) for t in range(rng.choice([0, 1, 2, 3, 5, 9, 30]))]
    rows += [(c, t, "user", f"same {t}") for c in range(200, 240) for t in range(17)]
    rows += [(300, t, "user", f"long {t % 5}") for t in range(700)]
    rows += [(301, t, "user", f"long {t % 5}" if t != 650 else "other") for t in range(690)]
    df = spark.createDataFrame(rows, KIND).repartition(6)
    turns = plain_turns(rows)
    assert found(prefix_trie.conversation_trie(df)) == plain_nodes(turns)
    assert found(prefix_trie.rebuilt_trie(df)) == plain_nodes(plain_rebuilt(turns))


def test_a_long_conversation_runs_over_several_tasks(spark):
    rows = spark.range(5000).selectExpr("if(id < 4000, 7, id % 3) conv_id", "id turn", "id * 3 x",
                                        "id ^ 5 y")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # so little data would be put into one task
    try:
        out = prefix_trie.running(rows, "conv_id", ["turn"], adds=("x",), xors=("y",))
    finally:
        spark.conf.unset(setting)
    parts = {r["part"] for r in spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0]).select(
        "part").distinct().collect()}
    assert len(parts) > 1
    sums, marks = defaultdict(int), defaultdict(int)
    for r in sorted(out.collect(), key=lambda r: (r["conv_id"], r["turn"])):
        sums[r["conv_id"]] += r["turn"] * 3
        marks[r["conv_id"]] ^= r["turn"] ^ 5
        assert (r["x"], r["y"]) == (sums[r["conv_id"]], marks[r["conv_id"]])


@pytest.mark.parametrize("low,high,expected", [(0, 1, 1), (0, 7, 4), (4, 7, 6), (5, 7, 6), (6, 7, 7),
                                               (2, 9, 8), (9, 11, 10), (0, 1 << 40, 1 << 40)])
def test_fattest(spark, low, high, expected):
    assert spark.range(1).selectExpr(prefix_trie.fattest(f"{low}L", f"{high}L")).first()[0] == expected


def test_edges(spark):
    kind = KIND + ", p long, e long, n_convs string"
    rows = [(1, None, None, None), (1, None, "user", "b"), (1, 2, "user", "x " * 100_000),
            (2, 0, "user", "only"), (2, 0, "user", "only"), (None, 1, "user", "lost"),
            (20, 1, "", ""), (20, 1, None, None), (21, 1, "user", "é\u0000x"), (25, 1, "user", "y")]
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], kind)
    turns = plain_turns(rows)
    assert found(prefix_trie.conversation_trie(df)) == plain_nodes(turns)
    assert found(prefix_trie.rebuilt_trie(df)) == plain_nodes(plain_rebuilt(turns))
    assert found(prefix_trie.rebuilt_trie(df.limit(0))) == []
    alone = [(c, 1, "user", "z") for c in range(1, 12)]  # some lose their only turn
    rebuilt = plain_rebuilt(plain_turns(alone))
    assert not all(rebuilt.values())
    assert found(prefix_trie.rebuilt_trie(spark.createDataFrame(alone, KIND))) == plain_nodes(rebuilt)
    turnless = [(c, 1, "user", "z") for c, own in rebuilt.items() if not own]
    assert found(prefix_trie.rebuilt_trie(spark.createDataFrame(turnless, KIND))) == plain_nodes(
        {c: [] for c, *_ in turnless})
