"""Nearest vectors by inner product, approximately, through a permutation index.

Pivots are a sample of the vectors.  A vector is represented by the order of its nearest pivots,
nearest first, cut after ``prefix`` of them.  Two such orders are compared by Spearman's footrule; a
pivot that one of them lacks counts as standing just behind its end.  With weights prefix - place,
0 where the pivot is lacking, the footrule distance is prefix * (prefix + 1) less twice the sum of
the smaller weights, so that sum ranks alike and only shared pivots enter it.

Inverted files: some of the pivots head a list each; a vector is posted, with its order, in the list of
the nearest head.  A query reads the lists of its nearest heads, ranks what it finds by footrule,
reranks the best by exact inner products and keeps the nearest.  Lists longer than a task should hold
are cut into blocks by a hash, and a query goes to all blocks of a list that it reads.  It reads in
phases, each of several times as many lists as all before, and what the earlier ones have found is the
score that later ones must reach; so each phase returns about as many rows as the one before.

How many lists a query reads, and which share of the ranking is reranked, is measured: a few of the
vectors are searched exactly, and the smallest numbers that find ``target`` of their neighbours are
taken.  The sample (pivots, vectors that give the share's footrule threshold, vectors searched
exactly) is bounded by ``pivots``, SAMPLE and TRIALS; every vector is indexed.

Equal vectors are one point of the index, however many there are.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import discard, materialise

#: Fewest and most pivots; in between, the square root of the number of distinct vectors.
PIVOTS, MOST_PIVOTS = 128, 2048
#: Vectors that a query's footrule threshold is read from, and vectors searched exactly.
SAMPLE, TRIALS = 4096, 64
#: Fewest lists, vectors that a list should have where there are more, and vectors of a block.
LISTS, LIST, BLOCK = 16, 8192, 8192
#: A phase ends at so many times the lists read before, and one more.
PHASE = 4
#: Queries compared with a block at once, and pairs reranked at once.
TOGETHER, PAIRS = 128, 1 << 14
#: All pairs of a block are multiplied at once where at least one of so many is reranked.
DENSE = 32
#: Up to so many components for each place of an order, a product costs less than the footrule.
SHORT = 4


def inner_products(a, b):
    """Row by row in double precision, summed from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1] if a.shape[1] else np.zeros(len(a))


class Pivots:
    def __init__(self, vectors, heads, prefix):
        self.vectors, self.heads = np.asarray(vectors, np.float64), heads
        self.prefix = min(prefix, len(self.vectors))

    def orders(self, vectors):
        """(places of all pivots from the nearest on, heads from the nearest on)."""
        near = vectors @ self.vectors.T
        return (np.argsort(-near, 1, kind="stable")[:, :self.prefix].astype(np.uint16),
                np.argsort(-near[:, :self.heads], 1, kind="stable"))

    def weights(self, orders):
        """(vectors, pivots): prefix - place of each pivot, 0 where it is lacking."""
        out = np.zeros((len(orders), len(self.vectors)), np.uint16)
        np.put_along_axis(out, orders.astype(np.int64), np.broadcast_to(np.arange(
            self.prefix, 0, -1, dtype=np.uint16), orders.shape), 1)
        return out


def likeness(queries, entries):
    """Sums of the smaller weights, (queries, entries): the nearer by footrule, the larger.

    ``queries`` is (queries, pivots), ``entries`` is (pivots, entries).  Only the pivots of a query's
    own order enter its sums, however many there are.
    """
    out = np.zeros((len(queries), entries.shape[1]), np.uint16)
    smaller = np.empty(entries.shape[1], np.uint16)
    # Whole rows of a weight: with a single number numpy takes the minimum several times as slowly.
    rows = np.repeat(np.arange(queries.max(initial=0) + 1, dtype=np.uint16)[:, None],
                     entries.shape[1], 1)
    for query, sums in zip(queries, out):
        for pivot in np.flatnonzero(query):
            np.minimum(entries[pivot], rows[query[pivot]], out=smaller)
            np.add(sums, smaller, out=sums)
    return out


def _likeness_of(orders, entries, x, y):
    """``likeness`` of single pairs, given the orders of the queries."""
    out = np.empty(len(x), np.int64)
    own = np.arange(orders.shape[1], 0, -1, dtype=np.uint16)
    for s in range(0, len(x), PAIRS):
        out[s:s + PAIRS] = np.minimum(
            entries[orders[x[s:s + PAIRS]], y[s:s + PAIRS, None]], own).sum(1, dtype=np.int64)
    return out


def _products(queries, entries, x, y):
    out = np.empty(len(x))
    for s in range(0, len(x), PAIRS):
        out[s:s + PAIRS] = np.einsum("ij,ij->i", queries[x[s:s + PAIRS]], entries[y[s:s + PAIRS]])
    return out


def reaching(pivots, queries, orders, least, floor, entries, weights, count):
    """(query, entry) of all pairs whose likeness is ``least`` at least and whose inner product may be
    ``floor`` at least and one of the ``count`` largest of those of the query; in order of both.

    Products summed in any order differ by less than ``off``, so no pair is lost; what is not a
    number stays in.  Both conditions must hold, so the cheaper one is asked first where a floor is
    known.
    """
    dim = queries.shape[1]
    with np.errstate(all="ignore"):
        longest = np.sqrt((entries * entries).sum(1).max(initial=0))
        off = 4 * dim * np.finfo(np.float64).eps * longest * np.sqrt(
            (queries * queries).sum(1)) + np.finfo(np.float64).tiny
        known = np.isfinite(floor) & (dim <= SHORT * pivots.prefix)
        found = []
        for part in (np.flatnonzero(known), np.flatnonzero(~known)):
            if not len(part):
                continue
            if known[part[0]]:
                score = queries[part] @ entries.T
                x, y = np.nonzero(~(score < (floor - off)[part, None]))
                score = score[x, y]
                ranked = _likeness_of(orders[part], weights, x, y) >= least[part][x]
                x, y, score = x[ranked], y[ranked], score[ranked]
            else:
                ranked = likeness(pivots.weights(orders[part]), weights) >= least[part, None]
                x, y = np.nonzero(ranked)
                score = ((queries[part] @ entries.T)[x, y] if len(x) * DENSE >= ranked.size
                         else _products(queries[part], entries, x, y))
                reach = ~(score < (floor - off)[part][x])
                x, y, score = x[reach], y[reach], score[reach]
            ends = np.searchsorted(x, np.arange(len(part) + 1))
            keep = np.ones(len(x), bool)
            for query in np.flatnonzero(np.diff(ends) > count):
                own = score[ends[query]:ends[query + 1]]
                nth = np.partition(own, len(own) - count)[len(own) - count]
                keep[ends[query]:ends[query + 1]] = ~(own < nth - 2 * off[part[query]])
            found.append((part[x[keep]], y[keep]))
    x, y = map(np.concatenate, zip(*found))
    order = np.argsort(x, kind="stable")
    return x[order], y[order]


def _matrix(column, dtype, dim):
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dim)


# --------------------------------------------------------------------------- points and sample

def _rows(vectors):
    """(vec_id, point, embedding) of the vectors that take part, and their number and dimension.

    ``point`` is 128 bits of hash over the components: equal vectors have the same.
    """
    kind = vectors.schema["embedding"].dataType
    wide = not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(
        "array<double>" if wide else "array<float>").alias("embedding"))
    rows = rows.where(
        "vec_id is not null and forall(embedding, x -> x is not null and not isnan(x) and "
        "abs(x) != double('Infinity')) and exists(embedding, x -> x != 0)")
    halves = [F.lpad(F.hex(F.xxhash64(F.lit(seed), "embedding")), 16, "0") for seed in (1, 2)]
    rows = rows.withColumn("point", F.concat(*halves))
    most = rows.groupBy(F.size("embedding").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("point").alias("points")).orderBy(
        F.desc("n"), F.desc("dim")).first()
    dim, n, points = most if most else (0, 0, 0)
    return rows.where(F.size("embedding") == dim), n, points, dim, "f8" if wide else "f4"


def _sample(rows, size, dim):
    """At most ``size`` distinct vectors, chosen by hash, in the order of the hash."""
    chosen = rows.select("point").distinct().orderBy("point").limit(size).select("point")
    found = rows.join(F.broadcast(chosen), "point").groupBy("point").agg(
        F.first("embedding").alias("embedding")).orderBy("point").collect()
    return ([r["point"] for r in found],
            np.array([r["embedding"] for r in found], np.float64).reshape(-1, dim))


def _exact(trials, dim, count):
    """The nearest points of a few vectors, by comparing all: rows (trial, point, score, vector)."""
    points, vectors = trials

    def run(batches):
        held = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.array(batch.column("point").to_pylist())
            _, first = np.unique(own, return_index=True)
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            matrix = flat.reshape(-1, dim)[first].astype(np.float64)
            own = own[first]
            scores = vectors @ matrix.T
            scores[np.array(points)[:, None] == own[None, :]] = -np.inf
            keep = np.argsort(-scores, 1, kind="stable")[:, :count]
            for t in range(len(points)):
                best = held.setdefault(t, {})
                for k in keep[t]:
                    if np.isfinite(scores[t, k]):
                        best[own[k]] = (float(scores[t, k]), matrix[k].tobytes())
                if len(best) > count:
                    held[t] = dict(sorted(best.items(), key=lambda x: -x[1][0])[:count])
        found = [(t, point, score, vector) for t, best in held.items()
                 for point, (score, vector) in best.items()]
        if found:
            trial, point, score, vector = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(trial, pa.int32()), pa.array(point, pa.string()), pa.array(score),
                 pa.array(vector, pa.binary())], names=["trial", "point", "score", "vector"])
    return run


def _settings(rows, pivots, sample, trials, dim, count, target):
    """(lists to read, share to rerank) that find ``target`` of the trials' exact neighbours."""
    near = Window.partitionBy("trial").orderBy(F.desc("score"), "point")
    found = rows.select("point", "embedding").mapInArrow(
        _exact(trials, dim, count), "trial int, point string, score double, vector binary"
    ).dropDuplicates(["trial", "point"]).withColumn("nth", F.row_number().over(near)).where(
        F.col("nth") <= count).select("trial", "vector").collect()  # TRIALS * count rows at most
    if not found:
        return pivots.heads, 1.0
    trial = np.array([r["trial"] for r in found])
    orders, heads = pivots.orders(_matrix(pa.array([bytes(r["vector"]) for r in found]), "f8", dim))
    own, own_heads = pivots.orders(trials[1])
    place = np.argsort(own_heads, 1)[trial, heads[:, 0]]  # of the neighbour's list in the query's order
    covered = np.array([(place < p).mean() for p in range(1, pivots.heads + 1)])
    probes = int(np.argmax(covered >= (1 + target) / 2)) + 1
    weights = pivots.weights(own)
    like = np.minimum(weights[trial], pivots.weights(orders)).sum(1)
    base = likeness(weights, pivots.weights(pivots.orders(sample)[0]).T)
    # The share of the sample that ranks as high as the neighbour.
    share = np.array([(base[t] >= x).mean() for t, x in zip(trial, like)])
    need = np.sort(np.where(place < probes, share, np.inf))
    share = float(need[min(len(need) - 1, int(np.ceil(target * len(need))) - 1)])
    return probes, min(1.0, share * 1.05)


# ------------------------------------------------------------------------- the inverted files

_INDEX = "no long, point string, low long, held int, is_query boolean, list int, orders binary, " \
         "vector binary"
_POSTS = "list int, block int, kind int, no long, low long, held int, least int, floor double, " \
         "orders binary, vector binary"


def _place(shared, dim, dtype):
    def run(batches):
        pivots = shared.value
        for batch in batches:
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False)
            matrix = flat.reshape(-1, dim)
            orders, heads = pivots.orders(matrix.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("no", "point", "low", "held", "is_query")),
                 pa.array(heads[:, 0], pa.int32()),
                 pa.array([o.tobytes() for o in orders], pa.binary()),
                 pa.array([m.tobytes() for m in matrix.astype(dtype)], pa.binary())],
                names=[f.split()[0] for f in _INDEX.split(", ")])
    return run


def _posts(no, low, held, orders, vectors, lists, blocks, least, floor, kind):
    count = len(no)
    return pa.RecordBatch.from_arrays(
        [pa.array(lists, pa.int32()), pa.array(blocks, pa.int32()),
         pa.array(np.full(count, kind), pa.int32()), no, low, held, pa.array(least, pa.int32()),
         pa.array(floor, pa.float64()), orders, vectors], names=[f.split()[0] for f in _POSTS.split(", ")])


def _post_entries(blocks):
    """Each vector in a block of its list."""
    def run(batches):
        for batch in batches:
            lists = batch.column("list").to_numpy()
            no = batch.column("no").to_numpy()
            block = (no.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                     ).astype(np.int64) % blocks.value[lists]
            yield _posts(*(batch.column(c) for c in ("no", "low", "held", "orders", "vector")),
                         lists, block, np.zeros(len(no)), np.zeros(len(no)), 0)
    return run


def _post_queries(shared, blocks, sample, first, last, share, dim, dtype):
    """Each query in all blocks of its lists from ``first`` to ``last``, with the least likeness to
    rerank and the least score to return."""
    def run(batches):
        pivots = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                vectors = _matrix(part.column("vector"), dtype, dim).astype(np.float64)
                orders, heads = pivots.orders(vectors)
                if share >= 1:
                    least = np.zeros(len(vectors), np.int64)
                else:
                    base = np.sort(likeness(pivots.weights(orders), sample.value), 1)
                    cut = int(np.floor((1 - share) * base.shape[1]))
                    least = base[:, min(cut, base.shape[1] - 1)].astype(np.int64)
                lists = heads[:, first:last]
                often = blocks.value[lists]
                total = often.sum(1)
                row = np.repeat(np.arange(len(vectors)), total)
                cell = np.repeat(lists.reshape(-1), often.reshape(-1))
                ends = np.cumsum(often.reshape(-1))
                floor = part.column("floor").to_numpy()
                block = np.arange(len(cell)) - np.repeat(ends - often.reshape(-1), often.reshape(-1))
                for s in range(0, len(row), 4096):
                    own = row[s:s + 4096]
                    take = pa.array(own)
                    yield _posts(*(part.column(c).take(take)
                                   for c in ("no", "low", "held", "orders", "vector")),
                                 cell[s:s + 4096], block[s:s + 4096], least[own], floor[own], 1)
    return run


def _search(shared, dim, dtype, count):
    """The nearest entries of each query in its block; rows come sorted by list, block and kind."""
    def answer(queries, entries):
        pivots = shared.value
        no, low, held, weights, vectors = entries
        q_no = queries.column("no").to_numpy()
        q = _matrix(queries.column("vector"), dtype, dim).astype(np.float64)
        orders = _matrix(queries.column("orders"), np.uint16, pivots.prefix)
        floor = queries.column("floor").to_numpy()
        x, y = reaching(pivots, q, orders, queries.column("least").to_numpy(), floor, vectors, weights,
                        count)
        score = np.empty(len(x))
        for s in range(0, len(x), PAIRS):
            score[s:s + PAIRS] = inner_products(q[x[s:s + PAIRS]], vectors[y[s:s + PAIRS]])
        reach = score >= floor[x]
        x, y, score = x[reach], y[reach], score[reach]
        order = np.lexsort((low[y], -score, x))
        x, y, score = x[order], y[order], score[order]
        nth = np.arange(len(x)) - np.searchsorted(x, x, side="left")
        keep = nth < count
        x, y, score = x[keep], y[keep], score[keep]
        return pa.RecordBatch.from_arrays(
            [pa.array(q_no[x]), pa.array(no[y]), pa.array(low[y]), pa.array(held[y], pa.int32()),
             pa.array(score)], names=["query", "no", "low", "held", "score"])

    def run(batches):
        now, parts, entries = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("list", "block", "kind")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                run_, key, kind = batch.slice(start, end - start), tuple(keys[start, :2]), keys[start, 2]
                if key != now:
                    now, parts, entries = key, [], None
                if kind == 0:
                    parts.append(run_)
                    continue
                if not parts:
                    continue
                if entries is None:
                    table = pa.Table.from_batches(parts).combine_chunks()
                    orders = _matrix(table.column("orders"), np.uint16, shared.value.prefix)
                    entries = (*(table.column(c).to_numpy() for c in ("no", "low", "held")),
                               np.ascontiguousarray(shared.value.weights(orders).T),
                               _matrix(table.column("vector"), dtype, dim).astype(np.float64))
                for at in range(0, run_.num_rows, TOGETHER):
                    yield answer(run_.slice(at, TOGETHER), entries)
    return run


def nearest(vectors, neighbours=20, queries="vec_id % 20 = 0", target=0.95, pivots=None, prefix=64):
    """query_id, rank, vec_id, score: each query's ``neighbours`` nearest other rows that were found.

    ``vectors`` needs vec_id and embedding (an array of numbers); further columns are ignored.
    ``queries`` says which rows are queries.  Nearest is the largest inner product; equal scores
    rank by vec_id.  A query with fewer candidates gets all of them.  Rows with a null vec_id, and
    vectors that are null, empty, zero, hold null or non-finite components, or have another length
    than most rows (ties: the longer), take no part.  Rows that repeat a vec_id are candidates of
    their own; a query leaves out one row, its own.  Equal query rows give one result.

    ``target``: the share of true neighbours that the index is set to find.  Pivots and all other
    choices are functions of the vectors.
    """
    spark = vectors.sparkSession
    rows, total, points, dim, dtype = _rows(vectors)
    heads_wanted = max(LISTS, min(MOST_PIVOTS, points // LIST))
    wanted = pivots or max(PIVOTS, min(MOST_PIVOTS, int(points ** 0.5)))
    ids, taken = _sample(rows, wanted + SAMPLE + TRIALS, max(1, dim))
    if not ids:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = min(wanted, len(ids))
    shape = Pivots(taken[:wanted], min(heads_wanted, wanted), prefix)
    chosen = slice(wanted, wanted + TRIALS) if len(ids) > wanted else slice(TRIALS)
    trials = ids[chosen], taken[chosen]
    rest = taken[wanted + TRIALS:]
    rest = rest if len(rest) >= 256 else taken
    probes, share = _settings(rows, shape, rest, trials, dim, neighbours, target)

    shared = spark.sparkContext.broadcast(shape)  # MOST_PIVOTS vectors at most
    sample = spark.sparkContext.broadcast(np.ascontiguousarray(
        shape.weights(shape.orders(rest)[0]).T))
    # No query needs more than so many rows of one point.
    most = neighbours + 1
    by_id = Window.partitionBy("point").orderBy("vec_id")
    members = materialise(rows.select("point", "vec_id").withColumn(
        "nth", F.row_number().over(by_id)).where(F.col("nth") <= most).withColumn(
        "copy", F.row_number().over(Window.partitionBy("point", "vec_id").orderBy("nth"))),
        "members")
    index = rows.groupBy("point").agg(
        F.min("vec_id").alias("low"), F.least(F.count(F.lit(1)), F.lit(most)).cast("int").alias("held"),
        F.coalesce(F.max(F.expr(queries)), F.lit(False)).alias("is_query"),
        F.first("embedding").alias("embedding")).withColumn("no", F.monotonically_increasing_id())
    index = materialise(index.mapInArrow(_place(shared, dim, dtype), _INDEX), "index")
    lengths = np.zeros(shape.heads, np.int64)
    for r in index.groupBy("list").count().collect():  # one row per list
        lengths[r["list"]] = r["count"]
    blocks = spark.sparkContext.broadcast(np.maximum(1, -(-lengths // BLOCK)))

    near = Window.partitionBy("query").orderBy(F.desc("score"), "low", "no")

    def search(asked, probes, share):
        found, first = None, 0
        while first < probes:
            last = min(probes, first * (PHASE + 1) or 1)
            if found is None:
                phase = asked.withColumn("floor", F.lit(float("-inf")))
            else:
                reached = found.groupBy(F.col("query").alias("no")).agg(
                    F.count(F.lit(1)).alias("n"), F.min("score").alias("score")).where(
                    F.col("n") >= most).select("no", F.col("score").alias("floor"))
                phase = asked.join(reached, "no", "left").fillna(float("-inf"), ["floor"])
            posts = index.mapInArrow(_post_entries(blocks), _POSTS).unionByName(phase.mapInArrow(
                _post_queries(shared, blocks, sample, first, last, share, dim, dtype), _POSTS))
            hits = posts.repartition("list", "block").sortWithinPartitions(
                "list", "block", "kind").mapInArrow(
                _search(shared, dim, dtype, most),
                "query long, no long, low long, held int, score double")
            before = found
            found = materialise((hits if found is None else hits.unionByName(found)).withColumn(
                "nth", F.row_number().over(near)).where(F.col("nth") <= most).drop("nth"), "found")
            if before is not None:
                discard(before)
            first = last
        return found

    asked = index.where("is_query")
    found = search(asked, probes, share)
    # Queries that read too short lists read all of them.
    enough = found.groupBy(F.col("query").alias("no")).agg(F.sum("held").alias("got")).where(
        F.col("got") >= min(most, total)).select("no")
    short = materialise(asked.join(enough, "no", "left_anti"), "short")
    if not short.isEmpty():
        again = search(short, shape.heads, 1.0)
        found = found.join(short.select(F.col("no").alias("query")), "query", "left_anti").unionByName(
            again)
    named = index.select("no", "point")
    members = members.join(named, "point").select("no", "vec_id", "copy")
    by_vector = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "no")
    lists = found.select("query", "no", "score").join(members, "no").withColumn(
        "nth", F.row_number().over(by_vector)).where(F.col("nth") <= most).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct(  # at most ``most`` rows
            "nth", "vec_id", "score", "copy", (F.col("no") == F.col("query")).alias("own"))))
        .alias("near"))
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), "point").distinct().join(
        named, "point").select("query_id", F.col("no").alias("query"))
    return asked.join(lists, "query").select("query_id", F.posexplode(F.expr(
        f"slice(filter(near, x -> not (x.own and x.copy = 1 and x.vec_id = query_id)), 1, "
        f"{neighbours})")).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score")

