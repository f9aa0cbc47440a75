"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tripspark.llm import spelling

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_vocabulary(rows, noise):
    held = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            held[run] += 1
    return {w: n for w, n in held.items() if n >= 2 and len(w) >= 7}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def plain_variants(words):
    forms, counts, lengths = {}, {}, defaultdict(list)
    for w in words:
        lengths[len(w)].append((Counter(w), w))
    for w, n in words.items():
        letters = Counter(w)
        others = [v for k in (-1, 0, 1) for own, v in lengths[len(w) + k]
                  if (letters - own).total() <= 1 and near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        counts[w], forms[w] = len(others), best if best and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, counts[w], words.get(forms[w])))
    return out


def found(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in df.collect()}


def test_variants_of_the_test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = plain_vocabulary([(r["doc_id"], r["text"]) for r in docs.collect()], 31)
    assert len(words) > 50
    rows = found(spelling.spelling_variants(docs, noise=31))
    assert rows == plain_variants(words) and any(r[1] for r in rows)


@pytest.mark.parametrize("limit", [3, 20_000])
def test_dense_words(spark, monkeypatch, limit):
    """Words over few letters, so that all kinds of edits meet; small states unfold further."""
    monkeypatch.setattr(spelling, "STATE_WORDS", limit)
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))): rng.choice([1, 12, 150])
             for _ in range(400)}
    words |= {"abababab" + "b" * 300: 2, "abababab" + "b" * 301: 500, "a" * 2000: 3, "a" * 2001: 40}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.variants(df)) == plain_variants(words)


def test_pairs_of_one_acceptor_come_once():
    words = sorted({"aab", "ab", "abb", "b", "abc", "xabc", "axbc", "abcc", "ba"})
    pairs = [tuple(sorted(p)) for p in spelling.Acceptor(words).pairs()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and near(a, b)}


def test_acceptor_is_minimal():
    machine = spelling.Acceptor(["tapping", "tapings", "topping", "topings"])
    reached = {0}
    todo = [0]
    while todo:
        for q in machine.arcs[todo.pop()].values():
            if q not in reached:
                reached.add(q)
                todo.append(q)
    assert len(reached) == 11  # t, a/o shared after, p, p/i branches that meet in ing and ings


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 64)
    kind = "doc_id long, text string, word string, n string, state int"
    deep = "Straßenbahn āstraßenbahn x×÷yzabc " * 30 + "z" * 5000 + " " + "z" * 5001
    rows = [(1, deep, None, None, None), (1, deep, "clash", "n", 1), (None, "straßenbahm " * 2, "", "", 0),
            (2, None, None, None, None), (3, "", None, None, None), (4, "short ones", None, None, None)]
    docs = spark.createDataFrame(rows, kind)
    words = plain_vocabulary([r[:2] for r in rows], 31)
    assert words
    assert found(spelling.spelling_variants(docs, noise=31)) == plain_variants(words)
    assert found(spelling.spelling_variants(docs.limit(0))) == set()
