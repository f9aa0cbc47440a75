"""Helpers that several text operators share: slicing batches, word hashes, bitmaps, components."""

import contextlib
import ctypes
import gc
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise

#: Upper to lower case for A-Z only, on UTF-8 bytes.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: As LOWER; other ASCII that is neither letter nor digit becomes a space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
_UPPER_TEXT, _LOWER_TEXT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Python holds at most about this many bytes of text as separate words.
SLICE_BYTES = 1 << 21


def share_package(spark):
    """Let Python workers import this package, wherever they are started."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    held = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in held:
        env["PYTHONPATH"] = os.pathsep.join([root, *held])


def read_table(spark, sf_dir, name):
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column):
    return F.translate(column, _UPPER_TEXT, _LOWER_TEXT)


def crc_bucket(doc_id, buckets):
    """crc32 of the id as text, modulo ``buckets``; a null id falls in the bucket of ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(buckets))


def give_back():
    """Give back to the system what this process has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: What workers keep between tasks of one kind, by kind.
KEPT: dict = {}


def drop_kept(kind=None):
    """Forget what tasks of other kinds have kept in this process.

    Functions that travel to workers must call this one: of ``KEPT`` itself they would hold a copy.
    """
    others = [k for k, held in KEPT.items() if k != kind and held]
    for k in others:
        KEPT[k].clear()
    if others:
        give_back()


def tidy(run, kind=None):
    """``run`` for mapInArrow; at its end the task gives back to the system what it has freed.

    Workers are used again by later stages and would else each keep the largest size they ever had.
    Before it begins, what tasks of other kinds than ``kind`` have kept is forgotten.  A task without
    rows has nothing to give back.
    """
    def tidied(batches):
        drop_kept(kind)
        took = False

        def seen():
            nonlocal took
            for batch in batches:
                took = took or batch.num_rows > 0
                yield batch

        try:
            yield from run(seen())
        finally:
            if took:
                give_back()
    return tidied


def text_slices(batches, id_name="doc_id", text_name="text", limit=SLICE_BYTES):
    """Yield (ids, texts as bytes) of bounded size; a null text is empty.

    A single longer text comes alone.
    """
    for batch in batches:
        ids = batch.column(id_name).to_pylist()
        texts = batch.column(text_name).cast(pa.binary())
        start, held = 0, 0
        offsets = np.concatenate([[0], np.cumsum(
            np.array(pa.compute.fill_null(pa.compute.binary_length(texts), 0), dtype=np.int64))])
        while start < len(ids):
            held = offsets[start] + limit
            end = max(start + 1, int(np.searchsorted(offsets, held, side="right")) - 1)
            yield ids[start:end], [t or b"" for t in texts.slice(start, end - start).to_pylist()]
            start = end


def word_hashes(texts):
    """64-bit hashes of the lower-cased words of all texts, and each text's number of words."""
    words, counts = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.translate(LOWER).split()
        counts[i] = len(own)
        words += own
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), counts


def finish(h):
    """Mix a 64-bit array so that every bit depends on all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(hashes, counts, width):
    """Hashes of all runs of ``width`` words of each text, in order, and their number per text.

    A text with fewer words, but some, has one shingle: all its words.
    """
    total = len(hashes)
    starts = np.cumsum(counts) - counts
    out = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    if total == 0:
        return np.empty(0, np.uint64), out
    with np.errstate(over="ignore"):
        padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
        run = np.full(total, width, np.uint64)
        for j in range(width):
            run = run * _STEP + padded[j:j + total]
        first = np.repeat(starts, out) + (np.arange(out.sum()) - np.repeat(np.cumsum(out) - out,
                                                                           out))
        result = finish(run)[first]
        short = np.flatnonzero((counts > 0) & (counts < width))
        for d in short:
            value = np.array([counts[d]], np.uint64)
            for h in hashes[starts[d]:starts[d] + counts[d]]:
                value = value * _STEP + h
            result[(np.cumsum(out) - out)[d]] = finish(value)[0]
    return result, out


# ------------------------------------------------------------------ sums of fixed-size arrays

def array_rows(cells, chunks, dtype=np.int64):
    """Rows (chunk, part, data) of a fixed-size array, so that tasks can add theirs up."""
    pieces = np.array_split(np.ascontiguousarray(cells, dtype=dtype), chunks)
    part = int(cells.sum() % 16) if len(cells) else 0
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(chunks), pa.int32()), pa.array([part] * chunks, pa.int32()),
         pa.array([zlib.compress(p.tobytes(), 1) for p in pieces], pa.binary())],
        names=["chunk", "part", "data"])


ARRAY_SCHEMA = "chunk int, part int, data binary"


def _adder(dtype, bitwise):
    def add(batches):
        held = {}
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(),
                                   batch.column("data").to_pylist()):
                piece = np.frombuffer(zlib.decompress(data), dtype)
                if chunk not in held:
                    held[chunk] = piece.copy()
                elif bitwise:
                    held[chunk] |= piece
                else:
                    held[chunk] += piece
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([0] * len(held), pa.int32()),
                 pa.array([zlib.compress(p.tobytes(), 1) for p in held.values()], pa.binary())],
                names=["chunk", "part", "data"])
    return add


#: Tasks of the two rounds in which arrays are added up, at most: a Python task costs more than a few
#: pieces, however many partitions a shuffle has.
ROUNDS = 64, 16


def add_arrays(rows, dtype=np.int64, bitwise=False):
    """Add up (or OR) the arrays of all tasks; only one fixed-size array reaches the driver.

    Two rounds, so that no task reads a piece from every other task.
    """
    add = _adder(dtype, bitwise)
    once = rows.repartition("chunk", "part").coalesce(ROUNDS[0]).mapInArrow(tidy(add), ARRAY_SCHEMA)
    # The few pieces are put in order here: to sort them in Spark would first sample them, and with
    # that run each step twice.
    done = once.repartition("chunk").coalesce(ROUNDS[1]).mapInArrow(tidy(add), ARRAY_SCHEMA)
    done = sorted(done.collect(), key=lambda r: r["chunk"])
    return np.concatenate([np.frombuffer(zlib.decompress(r["data"]), dtype) for r in done]) \
        if done else None


BITMAP_BITS = 1 << 26


def bitmap_slots(values):
    """Two slots of a 64-bit hash in a bitmap of BITMAP_BITS bits."""
    return values & np.uint64(BITMAP_BITS - 1), (values >> np.uint64(32)) & np.uint64(
        BITMAP_BITS - 1)


def bitmap_of(df, column, make=None):
    """A Bloom bitmap of fixed size over a column of 64-bit hashes, for skipping non-members.

    ``make`` turns the column's numbers into hashes where it holds others.  The bitmap's size does not depend on the data; a fuller bitmap only skips less.
    """
    def mark(batches):
        bits = None
        for batch in batches:
            values = batch.column(column).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            values = values.view(np.uint64) if make is None else make(values)
            if bits is None:
                bits = np.zeros(BITMAP_BITS // 8, np.uint8)
            for slot in bitmap_slots(values):
                np.bitwise_or.at(bits, (slot >> np.uint64(3)).astype(np.int64),
                                 np.left_shift(1, (slot & np.uint64(7)).astype(np.uint8)
                                               ).astype(np.uint8))
        if bits is not None:
            yield array_rows(bits, 64, np.uint8)

    rows = df.select(F.col(column).cast("long")).mapInArrow(tidy(mark), ARRAY_SCHEMA)
    bits = add_arrays(rows, np.uint8, bitwise=True)
    return np.zeros(BITMAP_BITS // 8, np.uint8) if bits is None else bits


def in_bitmap(bits, values):
    """Which of the uint64 values may be in the bitmap."""
    first, second = bitmap_slots(values)
    hit = (bits[(first >> np.uint64(3)).astype(np.int64)]
           >> (first & np.uint64(7)).astype(np.uint8)) & 1
    where = np.flatnonzero(hit)
    second = second[where]
    also = (bits[(second >> np.uint64(3)).astype(np.int64)]
            >> (second & np.uint64(7)).astype(np.uint8)) & 1
    out = np.zeros(len(values), bool)
    out[where[also.astype(bool)]] = True
    return out


def hashed_ids(values):
    return finish(np.asarray(values).astype(np.int64).view(np.uint64) + _STEP)


def ids_bitmap(ids):
    """The bitmap of a column doc_id, broadcast; ids are hashed in the worker that marks them."""
    return ids.sparkSession.sparkContext.broadcast(bitmap_of(ids, "doc_id", hashed_ids))


def maybe_among(batches, bits):
    """The rows whose doc_id may be in the bitmap; rows without one are not."""
    for batch in batches:
        batch = batch.filter(pa.compute.is_valid(batch.column("doc_id")))
        yield batch.filter(pa.array(in_bitmap(
            bits.value, hashed_ids(batch.column("doc_id").to_numpy())), pa.bool_()))


def rows_without_ids(rows, gone):
    """Rows whose doc_id is not among ``gone`` (one column, doc_id).

    A bitmap of fixed size lets most rows pass as they are; only the others are shuffled, and the
    anti-join decides.  Rows without an id stay.
    """
    gone = gone.where("doc_id is not null").distinct()
    bits = ids_bitmap(gone)

    def part(inside):
        def run(batches):
            for batch in batches:
                ids = batch.column("doc_id").cast(pa.int64())
                hit = in_bitmap(bits.value, hashed_ids(pa.compute.fill_null(ids, 0).to_numpy()))
                hit &= pa.compute.is_valid(ids).to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(hit if inside else ~hit))
        return run

    clear, doubtful = (rows.mapInArrow(tidy(part(inside)), rows.schema) for inside in (False, True))
    return clear.unionByName(doubtful.join(gone, "doc_id", "left_anti"))


def rows_with_ids(docs, ids, make, schema):
    """``make`` over the batches of rows whose doc_id is among ``ids``, joined back to those.

    ``ids`` has one column, doc_id; ``make`` yields batches with a column doc_id.  Before any shuffle
    a bitmap of fixed size skips most other rows; the semi-join decides.
    """
    ids = ids.where("doc_id is not null").distinct()
    bits = ids_bitmap(ids)
    with small_batches(docs.sparkSession, 1000):
        found = materialise(docs.mapInArrow(tidy(
            lambda batches: make(maybe_among(batches, bits))), schema).join(
            ids, "doc_id", "left_semi"), "found")
    bits.unpersist()
    return found


@contextlib.contextmanager
def small_batches(spark, rows):
    """Within it, Arrow batches have at most so many rows: for steps whose rows are wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextlib.contextmanager
def shuffles_removed(spark):
    """Tables written within it leave no shuffle files behind; only the tables are read later."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


# --------------------------------------------------------------------- connected components

def components(edges):
    """(node, component) for all nodes of the edges (a, b); the component is its smallest node.

    Alternates large and small stars over written tables until nothing changes.
    """
    pair = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, seen = materialise(pair, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
        if state == seen or not state["n"]:
            break
        seen = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        before, now = now, materialise(small.union(least).distinct(), "edges")
        discard(before, large)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
