"""The stages of the corpus pipeline, each on what its predecessor kept, against plain Python."""

import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from test_brute_force import groups, shingles
from tripspark.llm import decontaminate, toxicity
from tripspark.llm.common import read_table


def test_stages_and_run(spark, sf):
    docs = read_table(spark, sf, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == columns
        rows = out.collect()
        kept[name] = rows
        docs = spark.createDataFrame(rows, out.schema)
    whole = read_table(spark, sf, "documents").collect()

    scores = toxicity.toxicity_scores(*[read_table(spark, sf, n) for n in (
        "documents", "documents", "labels")]).collect()
    toxic = {r["doc_id"] for r in scores if r["predicted"]}
    assert {r["doc_id"] for r in kept["toxicity"]} == {r["doc_id"] for r in whole} - toxic

    sets = {r["doc_id"]: shingles(r["text"], 5) for r in kept["toxicity"]}
    assert sorted(r["doc_id"] for r in kept["near_duplicates"]) == sorted(
        i for i, group in groups(sets, 80).items() if i == group)

    items = [set(shingles(r["text"], 8)) for r in read_table(spark, sf, "benchmark").collect()]
    before = {r["doc_id"]: r for r in kept["near_duplicates"]}
    after = {r["doc_id"] for r in kept["decontamination"]}
    leaks = {i for i, r in before.items()
             if any(len(item) and item <= shingles(r["text"], 8) for item in items)}
    assert leaks and not leaks & after
    found = decontaminate.overlaps(spark.createDataFrame(list(before.values())),
                                   read_table(spark, sf, "benchmark")).collect()
    assert set(before) - after == {r["doc_id"] for r in found}

    read = Counter(r["doc_id"] for r in kept["mixing"])
    assert set(read) == after and max(read.values()) <= 3
    assert {tuple(r) for r in kept["mixing"]} == {tuple(r) for r in kept["decontamination"]}

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, start = [], 0
    for r in sorted(kept["mixing"], key=lambda r: r["doc_id"]):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == expected
