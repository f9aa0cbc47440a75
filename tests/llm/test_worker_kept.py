"""What Python workers keep between stages, as functions meet it that have travelled to a worker."""

import pickle

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import cloudpickle

from tripspark.llm import common, token_files


def sent(function):
    return pickle.loads(cloudpickle.dumps(function))


def test_a_sent_function_forgets_the_encoders():
    run = sent(token_files._without_encoders(lambda batches: batches))
    token_files._ENCODERS["path"] = object()
    assert list(run(iter([1, 2]))) == [1, 2]
    assert not token_files._ENCODERS


def test_tasks_of_another_kind_forget_and_those_of_the_same_kind_keep():
    same, other = sent(common.tidy(iter, "encoders")), sent(common.tidy(iter))
    token_files._ENCODERS["path"] = object()
    list(same(iter([])))
    assert token_files._ENCODERS
    list(other(iter([])))
    assert not token_files._ENCODERS


def test_remembered_words_give_the_same_ids(monkeypatch):
    """However few words are remembered, and whichever generation holds them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = np.random.default_rng(3)
    words = ["Straße.", "été,", "x" * 500, "𝄞", "a.b", "12", "Word", "word."] + [
        "".join(rng.choice(list("abcdeé"), 4)) for _ in range(200)]
    texts = [" ".join(rng.choice(words, 30)) for _ in range(20)] + ["", " \n "]
    for most, size in ((1_000_000, 1 << 25), (60, 1 << 25), (1_000_000, 400)):
        monkeypatch.setattr(token_files, "REMEMBERED", most)
        monkeypatch.setattr(token_files, "REMEMBERED_BYTES", size)
        coder = token_files.WordEncoder(path)
        for part in (texts[:7], texts[7:9], texts[9:], texts[:3]):
            ids, counts = coder.encode(pa.array(part, pa.string()))
            whole = coder._alone(part)
            assert counts.tolist() == [len(w) for w in whole]
            assert ids.tolist() == [i for w in whole for i in w.tolist()]
