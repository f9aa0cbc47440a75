"""The seating of single customers, and the pairs of a part, do no more work than they need."""

import numpy as np
import pyarrow as pa
import pytest

from tripspark.llm import hpy_lm


class Draws:
    """A generator that counts the calls of its slow method."""

    def __init__(self, seed):
        self.own, self.calls = np.random.default_rng(seed), 0
        self.random = self.own.random

    def binomial(self, *args):
        self.calls += 1
        return self.own.binomial(*args)


def plainly(customers, base, others, discount, rng):
    tables, seated = np.ones(len(customers), np.int64), 1
    while (customers > seated).any():
        at = np.flatnonzero(customers > seated)
        group = 1 if seated < hpy_lm.SINGLY else seated // 16
        new = (hpy_lm.CONCENTRATION + discount * (others[at] + tables[at])) * base[at]
        old = seated - discount * tables[at]
        tables[at] += rng.binomial(np.minimum(group, customers[at] - seated), new / (new + old))
        seated += group
    return tables


@pytest.mark.parametrize("most,calls", [(hpy_lm.SINGLY, False), (5000, True)])
def test_seats_are_those_of_plain_draws(most, calls):
    rng = np.random.default_rng(5)
    customers = np.minimum(rng.zipf(1.4, 5000), most)
    base, others = rng.random(5000) ** 5 + 1e-9, rng.integers(0, 1000, 5000)
    mine, plain = Draws(7), Draws(7)
    assert (hpy_lm._seat(customers, base, others, 0.6, mine)
            == plainly(customers, base, others, 0.6, plain)).all()
    assert mine.random() == plain.random()
    assert bool(mine.calls) == calls


def test_parts_sort_their_own_pairs_only(monkeypatch):
    monkeypatch.setattr(hpy_lm, "TaskContext", type("Task", (), {
        "get": staticmethod(lambda: type("Context", (), {"partitionId": lambda self: 0})())}))
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, 50) % 500) for _ in range(40)]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(40)), pa.array(texts), *[pa.array([True] * 40)] * 2],
        names=["doc_id", "text", "trained", "scored"])
    chunks, sorted_ = list(hpy_lm._chunks(hpy_lm.CHUNK)([rows])), []
    ranked = hpy_lm._ranked
    monkeypatch.setattr(hpy_lm, "_ranked", lambda n, most: sorted_.append(len(n)) or ranked(n, most))
    found = [b for p in range(hpy_lm.PARTS) for b in hpy_lm._count(8, p)(chunks)]
    total = sum(len(t.split()) + 1 for t in texts)
    assert sum(sorted_) == total
    whole = hpy_lm.Chunk(chunks[0], 0).pairs()
    counts = [hpy_lm._pairs_of(b, i)[2] for b in found for i in range(b.num_rows)]
    assert sum(map(len, counts)) == len(whole[0]) and sum(c.sum() for c in counts) == total
