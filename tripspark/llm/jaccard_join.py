"""Exact Jaccard join of documents over word shingles, as a join in a metric space.

The space holds the shingle sets; its distances are Jaccard's and, for fixed sizes, the size of the
symmetric difference.  Pivots of the first level are single shingles, in one global order, rarest
first.  A document lies in the Voronoi region of its nearest pivot, the first shingle that it
holds.  If two documents are within the radius, the triangle inequality bounds how many of its
shingles each can lack in the other, so a copy of a document in the regions of its next pivots, up
to that window, meets every partner in some region.  Whole documents as first pivots would be
useless here: nearly all documents have distance 1 from nearly all others, and every window would
cover every region.

Inside a region documents themselves are pivots, level by level.  A pivot is compared with all
others of its region.  What it links is one component, of which no further pair is needed; the
pivot then leaves the region, and regions of one component are closed.  The number of pivots grows
with each level, so a region of g near copies costs about g comparisons and ends after one level.
A pair is taken in the region of its first common pivot only, where the number of earlier pivots of
both bounds their distance.  Before sets are compared, counts of shingles in 64 fixed buckets give
another lower bound.  Nothing is capped: a level ends only when all open regions are joined.

Equal sets are one member: of each distinct set over the whole table only the document with the
smallest id enters regions.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise
from .common import (add_arrays, array_rows, bitmap_of, components, hashed_ids, ids_bitmap, in_bitmap,
                     maybe_among, shingle_hashes, small_batches, text_slices, tidy, word_hashes)

#: Cells of the count sketch that orders the pivots.  The order decides only how much work there is.
CELL_BITS = 20
BUCKETS = 64
#: Regions of so many documents are joined at once, and so many levels take one central pivot.
SMALL, CENTRAL_LEVELS = 8, 2


_FIRST = "doc_id long, n long, da long, db long, chunk int, part int, data binary"


def _first(width):
    """Each document's number of shingles and digest of its set, and after a task's last one how many
    shingles fall in each cell, as rows with a chunk."""
    names = [c.split()[0] for c in _FIRST.split(", ")]

    def run(batches):
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for ids, texts in text_slices(batches):
            shingles, counts = shingle_hashes(*word_hashes(texts), width)
            cells += np.bincount((shingles >> np.uint64(64 - CELL_BITS)).astype(np.int64),
                                 minlength=1 << CELL_BITS)
            ends = np.cumsum(counts)
            sizes, marks = np.zeros(len(ids), np.int64), np.zeros((len(ids), 2), np.int64)
            for i, (start, end) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
                own = np.unique(shingles[start:end])
                sizes[i] = len(own)
                marks[i] = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
            none = sizes == 0
            rest = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(marks[:, 0], mask=none),
                 pa.array(marks[:, 1], mask=none), pa.nulls(rest, pa.int32()),
                 pa.nulls(rest, pa.int32()), pa.nulls(rest, pa.binary())], names=names)
        if cells.any():
            rows = array_rows(cells, 64)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(64, pa.int64())] * 4 + list(rows.columns), names=names)
    return run


def _min_overlap(a, b, percent):
    """Fewest common shingles of two linked sets of sizes a and b."""
    return f"((({a}) + ({b})) * {percent} + {99 + percent}) div {100 + percent}"


def _sets(batches, width):
    """(doc_id, sorted distinct shingle hashes) of each document."""
    for ids, texts in text_slices(batches):
        shingles, counts = shingle_hashes(*word_hashes(texts), width)
        ends = np.cumsum(counts)
        for doc_id, start, end in zip(ids, (ends - counts).tolist(), ends.tolist()):
            yield doc_id, np.unique(shingles[start:end])


_REGIONS = "doc_id long, n long, buckets binary, pivots array<long>"


def _regions(width, percent, cells, members):
    """The size, bucket counts and pivots of each member: the regions in which it is copied."""
    def place(batches):
        counts, rows = cells.value, []

        def flush():
            ids, sizes, buckets, pivots = zip(*rows)
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(buckets, pa.binary()), pa.array(pivots, pa.list_(pa.int64()))],
                names=["doc_id", "n", "buckets", "pivots"])

        for doc_id, own in _sets(maybe_among(batches, members), width):
            n = len(own)
            if not n:
                continue
            window = n - (n * percent + 99) // 100 + 1
            rare = counts[(own >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            pivots = own[np.lexsort((own, rare))[:window]].view(np.int64)
            # Full buckets stop at 255, which keeps the bound a bound.
            buckets = np.minimum(np.bincount((own & np.uint64(BUCKETS - 1)).astype(
                np.int64), minlength=BUCKETS), 255).astype(np.uint8).tobytes()
            rows.append((doc_id, n, buckets, pivots))
            if len(rows) >= 2000:
                yield flush()
        if rows:
            yield flush()
    return place


def _near(percent):
    """Keep pairs whose bucket counts allow the overlap that a link needs."""
    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).astype(
                np.int64).reshape(-1, BUCKETS) for c in ("va", "vb"))
            sizes = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            most = sizes - 2 * ((sizes * percent + 99 + percent) // (100 + percent))
            ok = np.abs(a - b).sum(1) <= most
            yield batch.select(["a", "b"]).filter(pa.array(ok))
    return keep


def _linked(percent):
    """Keep pairs whose sets are linked."""
    def keep(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return keep


def _members(bits):
    """(pivot, doc_id, n, pos) of pivots that may have several documents."""
    def spread(batches):
        for batch in batches:
            lists = batch.column("pivots")
            pivots = lists.flatten().to_numpy()
            sizes = np.diff(np.asarray(lists.offsets))
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(pivots)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit = np.flatnonzero(in_bitmap(bits.value, pivots.view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pivots[hit]), *(pa.array(batch.column(c).to_numpy()[row[hit]])
                                          for c in ("doc_id", "n")), pa.array(pos[hit])],
                names=["pivot", "doc_id", "n", "pos"])
    return spread


def _sets_of(docs, pairs, width):
    """(doc_id, own, in_a, in_b): the sets of the documents that stand in the pairs, and on which side.

    Bitmaps may let further documents through; joins with the pairs drop them.
    """
    sides = [ids_bitmap(pairs.select(F.col(side).alias("doc_id")).distinct()) for side in "ab"]

    def build(batches):
        rows, held = [], 0

        def flush():
            ids, own = zip(*rows)
            rows.clear()
            hashed = hashed_ids(np.array(ids, np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(own, pa.binary()),
                 *(pa.array(in_bitmap(bits.value, hashed)) for bits in sides)],
                names=["doc_id", "own", "in_a", "in_b"])

        def either():
            for batch in batches:
                batch = batch.filter(pa.compute.is_valid(batch.column("doc_id")))
                hashed = hashed_ids(batch.column("doc_id").to_numpy())
                yield batch.filter(pa.array(in_bitmap(sides[0].value, hashed) | in_bitmap(
                    sides[1].value, hashed)))

        for doc_id, own in _sets(either(), width):
            rows.append((doc_id, own.tobytes()))
            held += own.nbytes
            if held > 1 << 22:
                yield flush()
                held = 0
        if rows:
            yield flush()

    with small_batches(docs.sparkSession, 1000):
        found = materialise(docs.mapInArrow(tidy(build), "doc_id long, own binary, in_a boolean, in_b boolean"),
                            "found")
    for bits in sides:
        bits.unpersist()
    return found


def _links(pairs, regions, docs, percent, width):
    """The pairs (a, b) that are linked, by bucket counts first and then by whole sets.

    The side that stands in fewer distinct documents should be a: its sets are moved once each.
    """
    sizes = regions.select("doc_id", "n", "buckets")
    for side in "ab":
        pairs = pairs.join(sizes.select(F.col("doc_id").alias(side), F.col("n").alias("n" + side),
                                        F.col("buckets").alias("v" + side)), side)
    near = materialise(pairs.mapInArrow(tidy(_near(percent)), "a long, b long").distinct(), "near")
    if near.isEmpty():
        return near
    sets, both = _sets_of(docs, near, width), near
    for side in "ba":
        both = both.join(sets.where("in_" + side).select(
            F.col("doc_id").alias(side), F.col("own").alias("s" + side)), side)
    with small_batches(docs.sparkSession, 100):  # each row holds two sets
        links = materialise(both.mapInArrow(tidy(_linked(percent)), "a long, b long").distinct(),
                            "links")
    discard(near, sets)
    return links


def jaccard_components(documents, percent=85, width=4):
    """One row per input row: doc_id, n_shingles, component_id.

    ``documents`` needs doc_id and text; further columns are ignored.  Words are separated by ASCII
    white space and lower-cased in A-Z.  A row of fewer than ``width`` words has one shingle, all
    its words; a row without words or with a null text has none and links with nothing.  Two rows
    link when 100 * intersection >= percent * union.  Rows of the same doc_id are one node.  A null
    doc_id cannot be a component: such a row links with nothing and its component_id is null.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    with small_batches(spark, 1000):
        first = materialise(docs.mapInArrow(tidy(_first(width)), _FIRST), "first")
    counts = add_arrays(first.where("chunk is not null").select("chunk", "part", "data"))
    if counts is None:
        counts = np.zeros(1 << CELL_BITS, np.int64)
    # One document stands for each distinct set.
    sets = first.where("chunk is null").select("doc_id", "n", "da", "db")
    classes = materialise(sets.where("da is not null and doc_id is not null").groupBy("da", "db").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")), "classes")
    reps = ids_bitmap(classes.select(F.col("rep").alias("doc_id")))
    # Ranks only need their order: 32 bits are enough and fixed in size.
    cells = spark.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))
    with small_batches(spark, 1000):
        regions = materialise(docs.mapInArrow(tidy(_regions(width, percent, cells, reps)), _REGIONS),
                              "regions")
    cells.unpersist()
    reps.unpersist()
    # Each row's member; a doc_id whose rows have different sets joins their members.
    copies = classes.where("size > 1").select("da", "db", F.col("rep").alias("of"))
    held = materialise(sets.join(copies, ["da", "db"], "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("of", "doc_id")).alias("rep")),
        "held")
    same = held.where("rep is not null").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("doc_id", "a")
    joined = held.join(same, "doc_id").where("a != rep").select("a", F.col("rep").alias("b"))

    shared = materialise(regions.select(F.explode("pivots").alias("pivot")).groupBy("pivot").agg(
        F.count(F.lit(1)).alias("m")).where("m > 1").select("pivot"), "shared")
    bits = spark.sparkContext.broadcast(bitmap_of(shared, "pivot"))
    members = regions.select("doc_id", "n", "pivots").mapInArrow(
        tidy(_members(bits)), "pivot long, doc_id long, n long, pos long")
    members = materialise(members.join(shared, "pivot"), "members")
    bits.unpersist()
    discard(shared)

    # The text that others are copies of has no shingles of its own, so most of its pivots are
    # shared; a copy's own shingles come first among its pivots.  The more central document leads.
    central = members.groupBy("doc_id").agg(
        F.expr(f"count(1) / (max(n) - (max(n) * {percent} + 99) div 100 + 1)").alias("central"))
    active = materialise(members.join(central, "doc_id"), "members")
    heads = active.groupBy("pivot").agg(F.min(F.struct(
        -F.col("central"), "doc_id", F.col("n").alias("na"), F.col("pos").alias("pa"))).alias("x")
    ).select("pivot", F.col("x.doc_id").alias("head"), "x.na", "x.pa")
    # Linked documents meet in the region of their first common pivot, and nothing before it is
    # shared there.  Elsewhere a pair may fail this; it is not needed there.
    fits = ("least(na - pa, nb - pb) >= " + _min_overlap("na", "nb", percent)
            + f" and 100 * least(na, nb) >= {percent} * greatest(na, nb)")

    # First level: the pivot of a region is its most central document.
    star = materialise(active.join(heads, "pivot").where("doc_id != head"), "star")
    discard(members, active)
    links = _links(star.withColumnsRenamed({"n": "nb", "pos": "pb"}).where(fits).select(
        F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct(), regions, docs, percent, width)
    found = components(links.union(joined))
    columns = ["pivot", "doc_id", "n", "pos", "central"]
    active = star.select(columns)
    before = star
    level = 1
    while True:
        labelled = active.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
            *columns, F.coalesce("component", "doc_id").alias("c"))
        open_ = labelled.groupBy("pivot").agg(
            F.count(F.lit(1)).alias("m"), F.min("c").alias("c0"), F.max("c").alias("c1"),
            F.min(F.struct(-F.col("central"), "doc_id"))["doc_id"].alias("head")).where(
            "c0 != c1").select("pivot", "m", "head")
        # Small regions are joined at once.  Large ones take their most central member in the first
        # levels, and then members by a hash, 64, 4096, ... of a region, at last all.
        leads = "doc_id = head" if level <= CENTRAL_LEVELS else (
            f"pmod(xxhash64(doc_id, {level}), m) < {64 ** (level - CENTRAL_LEVELS)}")
        active = materialise(labelled.join(open_, "pivot").withColumn(
            "lead", F.expr(f"m <= {SMALL} or {leads}")), "members")
        discard(before)
        before = active
        if active.isEmpty():
            break
        lead, rest = active.where("lead").alias("x"), active.alias("y")
        pairs = lead.join(rest, F.expr(
            "x.pivot = y.pivot and x.c != y.c and (not y.lead or x.doc_id < y.doc_id)")).selectExpr(
            "x.doc_id a", "y.doc_id b", "x.n na", "y.n nb", "x.pos pa", "y.pos pb")
        new = _links(pairs.where(fits).select("a", "b").distinct(), regions, docs, percent, width)
        if not new.isEmpty():
            links = links.union(new)
            found = components(links.union(joined))
        active = active.where("not lead").select(columns)
        level += 1
    discard(regions)
    return held.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


SQL = r"""
with recursive words as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as materialized (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 2),
              lambda i: array_to_string(w[i:i + 3], ' '))) end as s from words),
shingles as materialized (select doc_id, len(s) as n, hash(unnest(s)) as h from sets),
links as materialized (
  select a.doc_id as x, b.doc_id as y from shingles a join shingles b using (h)
  where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
  having 100 * count(*) >= 85 * (min(a.n) + min(b.n) - count(*))),
reach(x, y) as (select doc_id, doc_id from documents union
  select reach.x, links.y from reach join links on reach.y = links.x)
select sets.doc_id, len(s) as n_shingles, min(reach.y) as component_id
from sets join reach on sets.doc_id = reach.x group by sets.doc_id, len(s)
"""
