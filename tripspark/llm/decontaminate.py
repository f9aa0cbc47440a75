"""Benchmark decontamination by spaced seeds.

A seed looks at ``SPAN`` consecutive words through a fixed mask and ignores the others.  The span
falls into four interleaved classes of positions; each of the six masks sees two classes.  Any two
substituted words lie in at most two classes, so one mask sees neither: every window of SPAN words
with at most two substitutions gives an equal seed.  Seeds of the benchmark and of the documents
are joined; each hit fixes how item and document are aligned, and the words around it are compared.
A shorter item is a seed as a whole, through every mask that leaves out as many words as it may lack;
only lengths that the benchmark has are sought.

Only seeds that a bitmap of fixed size knows leave the tasks that read documents.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .common import (WORDS, bitmap_of, finish, in_bitmap, rows_with_ids, small_batches, text_slices,
                     tidy)

SPAN = 12
CLASSES = 4
#: Each mask keeps the positions of two of the four classes: 110011001100, 101010101010, ...
MASKS = list(itertools.combinations(range(CLASSES), 2))
#: Items of fewer words than this are too common as phrases; they match only unchanged.
MIN_WORDS = 5
#: An overlap is a window of so many words, or a whole shorter item, ...
WINDOW = 13
#: ... of which this share is equal, position by position.
SHARE = 0.8

_STEP = np.uint64(0x9E3779B97F4A7C15)


def short_masks(width):
    """The positions that each mask of an item of ``width`` words leaves out."""
    may_differ = 0
    while width >= MIN_WORDS and (width - may_differ - 1) / width >= SHARE:
        may_differ += 1
    return list(itertools.combinations(range(width), may_differ))


def _words(texts):
    words, counts = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.translate(WORDS).split()
        counts[i] = len(own)
        words += own
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), counts


def _seeds(hashes, counts, widths, whole):
    """Yield (seed, index of its text, position) arrays for one slice of texts.

    With each its length.  ``widths``: lengths of seeds below SPAN.  ``whole``: such a seed must be
    a whole text, as benchmark items are; otherwise every run of that length gives one.
    """
    starts = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - np.repeat(starts, counts)
    left = np.repeat(counts, counts) - place
    padded = np.concatenate([hashes, np.zeros(SPAN, np.uint64)])
    total = len(hashes)
    with np.errstate(over="ignore"):
        at = np.flatnonzero(left >= SPAN)
        parts = []
        for c in range(CLASSES):
            part = np.full(total, c + 1, np.uint64)
            for j in range(c, SPAN, CLASSES):
                part = part * _STEP + padded[j:j + total]
            parts.append(part[at])
        for m, (a, b) in enumerate(MASKS):
            yield finish(parts[a] * _STEP + parts[b] + np.uint64(m)), text[at], place[at], SPAN
        for width in widths:
            at = np.flatnonzero((left == width) & (place == 0) if whole else left >= width)
            terms, factor = [], _STEP
            for j in range(width):
                terms.append(padded[at + j] * factor)
                factor = factor * _STEP
            run = sum(terms, np.full(len(at), 100 + width, np.uint64))
            for m, out in enumerate(short_masks(width)):
                seed = run + np.uint64(m) * factor
                for j in out:
                    seed = seed - terms[j]
                yield finish(seed), text[at], place[at], width


def _batch(seeds, ids, places):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(seeds).view(np.int64)), pa.array(np.concatenate(ids), pa.int64()),
         pa.array(np.concatenate(places).astype(np.int64))], names=["seed", "id", "place"])


def _seed_rows(widths, whole, bits=None):
    def make(batches):
        for ids, texts in text_slices(batches, "id", "text"):
            hashes, counts = _words(texts)
            keys = np.array([-1 if i is None else i for i in ids], np.int64)
            null = np.array([i is None for i in ids])
            out = ([], [], [])
            for seed, text, place, width in _seeds(hashes, counts, widths, whole):
                if bits is not None:
                    at = np.flatnonzero(in_bitmap(bits.value, seed))
                    if width < MIN_WORDS:  # unchanged, so one place in a text is enough
                        at = at[np.lexsort((seed[at], text[at]))]
                        at = at[np.append(True, (np.diff(text[at]) != 0)
                                          | (seed[at][1:] != seed[at][:-1]))[:len(at)]]
                    seed, text, place = seed[at], text[at], place[at]
                known = ~null[text]
                for held, values in zip(out, (seed[known], keys[text[known]], place[known])):
                    held.append(values)
            yield _batch(*out)
    return make


def _word_rows(batches):
    for ids, texts in text_slices(batches):
        hashes, counts = _words(texts)
        ends = np.cumsum(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(counts),
             pa.array([hashes[e - c:e].tobytes() for e, c in zip(ends, counts)], pa.binary())],
            names=["doc_id", "n", "words"])


def _verify(batches):
    """For each alignment: equal words, and the best share in a window."""
    for batch in batches:
        equal, best = [], []
        for item, doc, shift in zip(batch.column("item").to_pylist(),
                                    batch.column("doc").to_pylist(),
                                    batch.column("shift").to_pylist()):
            item, doc = np.frombuffer(item, np.uint64), np.frombuffer(doc, np.uint64)
            same = np.zeros(len(item), np.int64)
            first = max(0, -shift)  # item words before the document's start
            size = min(len(item) - first, len(doc))
            same[first:first + size] = item[first:first + size] == doc[:size]
            width = min(WINDOW, len(item))
            sums = np.concatenate([[0], np.cumsum(same)])
            equal.append(int(same.sum()))
            best.append(float((sums[width:] - sums[:-width]).max()) / width)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("item_id"), pa.array(equal, pa.int64()),
             pa.array(best, pa.float64())], names=["doc_id", "item_id", "equal_words", "share"])


def overlaps(documents, benchmark):
    """(doc_id, item_id, equal_words, share): verified overlaps, the best of each pair.

    Words are lower-cased in A-Z; ASCII signs separate them.  Documents without text or id match
    nothing, nor do items without words; items below WINDOW words must occur whole, those of fewer
    than MIN_WORDS words unchanged.  Each item without an id has its own row, its item_id null.
    Equal items and repeated rows are compared like others.
    """
    spark = documents.sparkSession
    numbered = materialise(benchmark.select(
        F.monotonically_increasing_id().alias("id"), F.col("item_id").cast("long").alias("item_id"),
        F.col("text").cast("string").alias("text")), "benchmark")  # fixes the numbers
    items = numbered.select("id", "text")
    docs = documents.select(F.col("doc_id").cast("long").alias("id"),
                            F.col("text").cast("string").alias("text"))
    kinds = "seed long, id long, place long"
    item_words = materialise(items.withColumnRenamed("id", "doc_id").mapInArrow(
        _word_rows, "doc_id long, n long, words binary"), "items")
    widths = sorted(r["n"] for r in item_words.where(
        f"n > 0 and n < {SPAN}").select("n").distinct().collect())
    tests = materialise(items.mapInArrow(_seed_rows(widths, True), kinds).distinct(), "seeds")
    bits = spark.sparkContext.broadcast(bitmap_of(tests, "seed"))
    hits = docs.mapInArrow(tidy(_seed_rows(widths, False, bits)), kinds)
    with small_batches(spark, 1000):
        lined = materialise(
            hits.withColumnsRenamed({"id": "doc_id", "place": "at"}).join(
                tests.withColumnsRenamed({"id": "item_id"}), "seed").selectExpr(
                "doc_id", "item_id", "at - place as shift").distinct(), "hits")
    doc_words = rows_with_ids(docs.withColumnRenamed("id", "doc_id"), lined.select("doc_id"),
                              _word_rows, "doc_id long, n long, words binary")
    lined = lined.join(item_words.select(F.col("doc_id").alias("item_id"), F.col("n").alias("m"),
                                         F.col("words").alias("item")), "item_id")
    # Only the aligned words of the document reach Python.
    aligned = lined.join(doc_words.select("doc_id", "words"), "doc_id").select(
        "doc_id", "item_id", "item", "shift", F.expr(
            "substring(words, cast(greatest(shift, 0) * 8 + 1 as int), "
            "cast((m + least(shift, 0)) * 8 as int))").alias("doc"))
    found = aligned.mapInArrow(
        tidy(_verify), "doc_id long, item_id long, equal_words long, share double")
    found = found.where(F.col("share") >= SHARE).withColumnRenamed("item_id", "id").join(
        numbered.select("id", "item_id"), "id")
    return found.groupBy("doc_id", "item_id", F.when(F.col("item_id").isNull(), F.col("id")).alias(
        "id")).agg(F.max("equal_words").alias("equal_words"), F.max("share").alias("share")).drop("id")


def contamination(documents, benchmark):
    """One row per input row: doc_id, contaminated, n_items, item_id, equal_words.

    item_id is the item with most equal words, the smallest of several; null without an overlap
    and where only an item without an id has so many.
    """
    per_doc = overlaps(documents, benchmark).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.max("equal_words").alias("equal_words"),
        F.min(F.struct(-F.col("equal_words"), F.col("item_id").isNull(), "item_id"))[
            "item_id"].alias("item_id"))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id")).join(
        per_doc, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id",
        F.coalesce("equal_words", F.lit(0)).alias("equal_words"))
