"""Operators against plain Python over whole small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tripspark.llm import (decontaminate, hpy_lm, jaccard_join, mixing, queries,
                           token_files)

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows_of(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet").collect()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(A_Z))


def shingles(text, width):
    own = words(text)
    if not own:
        return frozenset()
    return frozenset(tuple(own[i:i + width]) for i in range(max(1, len(own) - width + 1)))


def groups(sets, percent):
    """Smallest reachable id, by comparing all pairs that share a shingle."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    for pair in {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}:
        x, y = (sets[i] for i in pair)
        if 100 * len(x & y) >= percent * len(x | y):
            a, b = map(find, pair)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("percent,width", [(85, 4), (80, 5), (30, 2)])
def test_jaccard_components(spark, sf, percent, width):
    docs = {r["doc_id"]: shingles(r["text"], width) for r in rows_of(spark, sf, "documents")}
    expected = groups(docs, percent)
    found = jaccard_join.jaccard_components(
        spark.read.parquet(f"{sf}/documents.parquet"), percent, width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {
        i: (len(s), expected[i]) for i, s in docs.items()}


def test_near_copies_of_one_text_and_chains(spark):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(150):  # copies with one or two words replaced, linked directly or over others
        own = list(base)
        for at in rng.choice(60, int(rng.integers(0, 3)), replace=False):
            own[at] = f"x{i}_{at}"
        texts.append(" ".join(own))
    for i in range(40):  # a chain: neighbours are linked, the ends are far apart
        texts.append(" ".join(f"c{j}" for j in range(i, i + 60)))
    texts += [f"shared passage of six words u{i} v{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = jaccard_join.jaccard_components(docs, 70, 4).collect()
    expected = groups({i: shingles(t, 4) for i, t in enumerate(texts)}, 70)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected


def test_token_files_against_the_tokenizer(spark, sf):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    odd = ["", None, "Don't STOP, it's 5€. İstanbul ŉaïve éa <|endoftext|>x", "a b\x1cc",
           "ǅ Ω.. ß, ﬁn … ​", "…,.", "Word, word. WORD,. word"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)],
                              "doc_id long, text string"))
    start, expected = 0, {}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        expected[r["doc_id"]] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = token_files.token_digests(docs, TOKENIZER).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in found} == expected


def test_language_model(spark, sf):
    docs = rows_of(spark, sf, "documents")
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in docs}
    counts = Counter(t for r in docs if not held[r["doc_id"]] for t in words(r["text"]) + ["\n"])
    total, kinds = sum(counts.values()), len(counts)
    found = {r["doc_id"]: r for r in queries.op7_language_model(spark, sf).collect()}
    better = worse = 0.0
    for r in docs:
        own = found[r["doc_id"]]
        tokens = words(r["text"]) + ["\n"]
        assert (own["held_out"], own["n_tokens"], own["train_tokens"]) == (
            held[r["doc_id"]], len(tokens), total)
        assert own["n_known"] == sum(t in counts for t in tokens)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        assert own["base_score"] == pytest.approx(base, rel=1e-9)
        if own["held_out"]:
            better, worse = better + own["score"], worse + base
    assert better > worse  # held-out texts are likelier than under the base


def test_language_model_is_a_distribution(spark):
    """In every context the probabilities of all words and the unknown one add up to 1."""
    texts = spark.createDataFrame([("a b a c a b",), ("b a d",), (None,), ("a a a a e e",)],
                                  "text string")
    blocks, model = hpy_lm.train(texts)
    table = blocks.mapInArrow(hpy_lm._predict(spark.sparkContext.broadcast(model)), hpy_lm._PREDICTIVE).collect()
    assert {r["n"] for r in table} and sum(r["n"] for r in table) == 15 + 4
    for context in range(hpy_lm.CLASSES):
        sums = 0.0
        back = [model.backoff(t)[context] for t in model.totals[-hpy_lm.SAMPLES:]]
        for r in table:
            sums += sum(b * r[f"p{s}"] for s, b in enumerate(back)) / len(back)
            sums += sum(v for c, v in zip(r["classes"], r["own"]) if c == context)
        sums += sum(b * model.unknown(t) for b, t in zip(
            back, model.totals[-hpy_lm.SAMPLES:])) / len(back)
        assert sums == pytest.approx(1.0)


def test_toxicity_on_held_out_rows(spark, sf):
    sf = sf.replace("0.001", "0.1")  # enough positives in each language
    labels = {r["doc_id"]: r["toxic"] for r in rows_of(spark, sf, "labels")}
    found = queries.op2_toxicity(spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["score"]) for r in found
            if r["held_out"] and r["doc_id"] in labels]
    pairs = [(p > n) + 0.5 * (p == n) for a, p in held if a for b, n in held if not b]
    assert np.mean(pairs) > 0.93


def test_decontamination_finds_verbatim_items(spark, sf):
    items = {r["item_id"]: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"].translate(A_Z))
             for r in rows_of(spark, sf, "benchmark")}
    found = {r["doc_id"]: r for r in queries.op9_decontamination(spark, sf).collect()}
    hits = 0
    for r in rows_of(spark, sf, "documents"):
        own = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                        (r["text"] or "").translate(A_Z))) + " "
        inside = {i for i, w in items.items() if f" {' '.join(w)} " in own}
        hits += bool(inside)
        assert found[r["doc_id"]]["contaminated"] >= bool(inside)
        assert found[r["doc_id"]]["n_items"] >= len(inside)
    assert hits


def test_decontamination_tolerates_substitutions(spark):
    item = [f"q{i}" for i in range(30)]
    changed = [w if i % 8 else "other" for i, w in enumerate(item)]  # every eighth word
    half = [w if i % 2 else "other" for i, w in enumerate(item)]
    docs = [(1, "before it " + " ".join(changed) + " after"), (2, " ".join(half)),
            (3, " ".join(item[10:23])), (4, " ".join(item[:9])), (5, None), (6, ""),
            (7, "Short, ITEM of five words!"), (8, "short item of five"), (None, " ".join(item))]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "short item of five words"),
                                   (3, "too short"), (4, None), (None, "a b c d e f"),
                                   (5, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"]: (r["contaminated"], r["n_items"], r["item_id"])
             for r in decontaminate.contamination(docs, bench).collect()}
    assert found == {1: (True, 2, 1), 2: (False, 0, None), 3: (True, 2, 1), 4: (False, 0, None),
                     5: (False, 0, None), 6: (False, 0, None), 7: (True, 1, 2),
                     8: (False, 0, None), None: (False, 0, None)}


def test_mixing(spark, sf):
    docs = rows_of(spark, sf, "documents")
    tokens = Counter()
    for r in docs:
        tokens[r["source"]] += len(words(r["text"]))
    found = queries.op6_mixing(spark, sf).collect()
    per_doc = Counter((r["doc_id"], r["epoch"]) for r in found)
    assert set(per_doc.values()) == {1} and {d for d, _ in per_doc} == {r["doc_id"] for r in docs}
    weights = {r["source"]: r["weight"] for r in found}
    assert sum(weights.values()) == pytest.approx(1.0)
    read = Counter()
    for r in found:
        read[r["source"]] += r["n_tokens"]
    passes = {s: read[s] / tokens[s] for s in tokens}
    assert max(passes.values()) <= 2.0 + max(len(words(r["text"])) for r in docs) / min(
        tokens.values())
    # The smallest exponent that keeps every source within two passes.
    exponent = mixing.solve_exponent(dict(tokens), repetition_limit=2.0)
    often = mixing.passes(tokens, mixing.weights(tokens, exponent), None)
    assert max(often.values()) == pytest.approx(2.0) and min(often.values()) == pytest.approx(1.0)
    for s, t in tokens.items():
        assert read[s] >= t and read[s] - often[s] * t < max(
            r["n_tokens"] for r in found if r["source"] == s)


def test_mixing_targets():
    tokens = {"a": 1000, "b": 100, "c": 10}
    a = mixing.solve_exponent(tokens, target_entropy=0.9)
    assert mixing.entropy(mixing.weights(tokens, a)) == pytest.approx(0.9)
    assert mixing.solve_exponent(tokens, target_entropy=2.0) == 0.0
    assert mixing.solve_exponent({"a": 5, "b": 0}, repetition_limit=2) == 1.0
    shares = mixing.weights(tokens, mixing.solve_exponent(tokens, repetition_limit=4, budget=1110))
    assert max(mixing.passes(tokens, shares, 1110).values()) == pytest.approx(4)


@pytest.mark.parametrize("target", [
    {"target_entropy": 2.0}, {"target_entropy": 9.0}, {"target_entropy": 0.0},
    {"repetition_limit": 2.0}, {"repetition_limit": 0.5}, {"repetition_limit": None},
    {"repetition_limit": 3.0, "budget": 200_000}, {"repetition_limit": 1.0, "budget": 10}])
def test_exponent_of_a_table_of_sources(spark, target):
    """Many exponents at a time find what plain bisection finds; no number of sources is refused."""
    tokens = {f"s{i}": i * i % 9973 for i in range(3000)}
    table = spark.createDataFrame(list(tokens.items()), "mix_source string, tokens long")
    exponent, total, norm, rate = mixing.table_exponent(table, **target)
    expected = mixing.solve_exponent(dict(tokens), **target)
    assert exponent == pytest.approx(expected, abs=1e-9)
    held = {s: t for s, t in tokens.items() if t}
    shares = mixing.weights(held, expected)
    often = mixing.passes(held, shares, target.get("budget"))
    assert total == sum(tokens.values())
    for s in ("s1", "s2999", "s1500"):
        mine = (tokens[s] / total) ** exponent / norm
        assert mine == pytest.approx(shares[s]) and rate * mine / tokens[s] == pytest.approx(often[s])


def test_mixing_with_a_budget(spark):
    rows = [(i, "w " * 10, "big" if i % 3 else "small") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, repetition_limit=None, budget=1500).collect()
    read = Counter()
    for r in found:
        read[r["source"]] += 10
    assert read["big"] == pytest.approx(750, abs=10) and read["small"] == pytest.approx(750, abs=10)


def test_html_extraction(spark, sf):
    """The generated pages hold their text in <article>; compare with a plain reading of it."""
    import html
    found = {r["page_id"]: r for r in queries.op3_html_extraction(spark, sf).collect()}
    for r in rows_of(spark, sf, "pages"):
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)
        if not inner:
            continue
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split())
                 for p in re.split(r"</?(?:p|h1)>", inner[1])]
        text = "\n".join(p for p in parts if p)
        assert found[r["page_id"]]["text"] == text
        assert found[r["page_id"]]["n_chars"] == len(text)


def test_entry_queries_are_registered():
    import __spark_entry__
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()
