"""The language model: real words before, and scores against the tables of the restaurants."""

import math
import pathlib

import numpy as np
import pytest
import xxhash

from tripspark.llm import hpy_lm


def key(word):
    return np.uint64(xxhash.xxh3_64_intdigest(word)) & ~hpy_lm._LOW


def test_words_of_like_endings_have_contexts_of_their_own(spark):
    """Both words before end in the same two bytes, and both words after occur as often."""
    texts = ["going red", "sowing blue"] * 20
    training = spark.createDataFrame([(t,) for t in texts], "text string")
    asked = ["going red", "going blue", "sowing red", "sowing blue", "going other"]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string")
    rows = hpy_lm.language_model_scores(docs, training).collect()
    score = {asked[r["doc_id"]]: r["score"] for r in rows}
    assert score["going red"] > score["going blue"] + 1
    assert score["sowing blue"] > score["sowing red"] + 1
    assert score["going blue"] > score["going other"]


def test_class_of_a_short_word_is_one_class():
    keys, before, _ = hpy_lm.tokens([b"a b\ta  b\na c a"])
    after = (before == key(b"a"))
    assert after.sum() == 4 and len(set((keys[after] & hpy_lm._LOW).tolist())) == 1


@pytest.mark.parametrize("piece,chunk", [(hpy_lm.PIECE, hpy_lm.CHUNK), (500, 40)])
def test_scores_follow_the_tables(spark, monkeypatch, piece, chunk):
    """Scores agree with plain sums over the tables, whatever the pieces and chunks."""
    monkeypatch.setattr(hpy_lm, "PIECE", piece)
    monkeypatch.setattr(hpy_lm, "CHUNK", chunk)
    texts = ["the cat sat on the mat", "the dog sat on the cat the dog", "", None, " \t ",
             "The CAT ran on and on and on", "a b\ta\nb a", "é 𝄞 é the cat sat"] * 3
    training = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    once, more, blocks, model, _ = hpy_lm._fit(training)
    pairs, words = {}, {}
    for rows in (once.toArrow(), more.toArrow()):
        for batch in rows.to_batches():
            for at in range(batch.num_rows):
                for k, b, n, t in zip(*hpy_lm._pairs_of(batch, at)):
                    assert (k & ~hpy_lm._LOW, b) not in pairs
                    pairs[k & ~hpy_lm._LOW, b] = n, t
    shared = spark.sparkContext.broadcast(model)
    for r in blocks.mapInArrow(hpy_lm._predict(shared), hpy_lm._PREDICTIVE).collect():
        words[np.uint64(r["word"] % (1 << 64))] = r
    assert sum(n for n, _ in pairs.values()) == model.tokens
    assert all(1 <= t <= n for n, t in pairs.values()) and any(n > 1 for n, _ in pairs.values())

    asked = [*texts[:8], "the the unseen cat", "on b and 𝄞", "sat"]
    docs = [(i if i else None, t) for i, t in enumerate(asked)]
    found = {r["doc_id"] or 0: r for r in hpy_lm.language_model_scores(
        spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), training).collect()}
    totals = model.totals[-hpy_lm.SAMPLES:]
    for i, text in enumerate(asked):
        keys, before, counts = hpy_lm.tokens([(text or "").encode()])
        expected = 0.0
        for k, b in zip(keys, before):
            word, group = k & ~hpy_lm._LOW, int(k & hpy_lm._LOW)
            row = words.get(word)
            p = sum(model.backoff(t)[group] * (row[f"p{s}"] if row else model.unknown(t))
                    for s, t in enumerate(totals)) / hpy_lm.SAMPLES
            if row:
                p += dict(zip(row["classes"], row["own"])).get(group, 0.0)
            own = [v for (_, c), v in pairs.items() if c == b]
            n, t = pairs.get((word, b), (0, 0))
            customers, tables = sum(c for c, _ in own), sum(t for _, t in own)
            d = model.pair_discount
            expected += math.log10((n - d * t + (hpy_lm.CONCENTRATION + d * tables) * p)
                                   / (hpy_lm.CONCENTRATION + customers))
        assert found[i]["n_tokens"] == counts[0]
        assert found[i]["score"] == pytest.approx(expected, rel=1e-6)


def test_answers_take_less_room_than_the_chunks_that_ask(spark, monkeypatch, tmp_path):
    """Pairs are sent once, for learning and scoring; words are asked for once with their classes."""
    sizes, plain = [], hpy_lm.materialise

    def written(df, name="table"):
        table = plain(df, name)
        files = pathlib.Path(table.scratch.removeprefix("file:")).rglob("*.parquet")
        sizes.append((name, sum(f.stat().st_size for f in files)))
        return table

    monkeypatch.setattr(hpy_lm, "materialise", written)
    ranks = np.random.default_rng(1).zipf(1.3, 150_000) % 1_000_000
    texts = [" ".join(f"w{r:x}" for r in ranks[i:i + 300]) for i in range(0, len(ranks), 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = hpy_lm.held_out_scores(docs).collect()
    assert sum(r["n_tokens"] for r in rows) == len(ranks) + len(texts)
    took = {n: sum(s for name, s in sizes if name == n) for n, _ in sizes}
    assert took["answers"] + took.get("found", 0) < 0.6 * took["chunks"]


def test_pairs_are_seated_in_as_many_sweeps_as_classes(spark, monkeypatch):
    """Each time given the tables of the time before, which classes have as their customers."""
    rounds, plain = [], hpy_lm._seat_pairs

    def seat(model, number):
        rounds.append((number, model.value.customers.sum()))
        return plain(model, number)

    monkeypatch.setattr(hpy_lm, "_seat_pairs", seat)
    texts = ["the cat sat on the mat", "the dog sat on the cat the dog", "on and on"] * 20
    training = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    once, more, blocks, model, _ = hpy_lm._fit(training)
    assert [n for n, _ in rounds] == list(range(hpy_lm.SWEEPS))
    tables = sum(int(hpy_lm._pairs_of(batch, at)[3].sum()) for part in (once, more)
                 for batch in part.toArrow().to_batches() for at in range(batch.num_rows))
    assert model.customers.sum() == tables
    # Before the first time every pair has one table.
    pairs = {p for t in texts for p in zip(["", *t.split()], [*t.split(), "\n"])}
    assert rounds[0][1] == len(pairs) and rounds[1][1] > rounds[0][1]
