"""Conversations as a z-fast trie over their turns.

A string is a conversation, a letter is a turn (role and text).  The compacted trie has a node for
the root, for each place where conversations part and for each place where one ends; the letters
between a node and its parent are the node's edge.  A prefix of d letters is named by 128 bits: the
XOR of one hash per place and turn.  So keys of all prefixes are running XORs, which Spark computes in
ranges cut through conversations of any length.

A node is hashed under its handle, the prefix of the two-fattest length of its edge: the depth in
(parent's depth, own depth] that most powers of two divide.  To find where a conversation leaves the
trie, fat binary search probes handles: of all depths left it takes the two-fattest, goes on below the
node it finds or above the depth where there is none, and so needs a number of probes that grows
with the logarithm of the turns.  A probe is one row per conversation, joined to its own key at that
depth and to the table of handles.

Conversations are inserted in batches, each several times larger than all before.  Those of a batch
that leave the trie on one edge, together with that edge, are grouped by prefix below the edge's upper
end; prefixes where they part or one ends become nodes, and the old node is replaced.

Sums over subtrees are taken on the compacted nodes, by doubling the distance to the ancestor that a
node reports to; then edges are expanded to one row per prefix.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.shared import discard, materialise
from .common import finish

#: Shares of the distinct conversations, in sixteenths, that the batches end at.
BATCHES = (1, 5, 16)
#: Positions of a conversation that a span is cut at, as powers of two: coarse, then fine.
COARSE, FINE = 18, 6
#: Ids of conversations joined to one piece of text.
PIECE = 50_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------------------------- the letters

def digests(conversations):
    """(conv_id, turn, mark, words): a 128-bit digest of role and text, and the text's words.

    Null roles and texts are empty; rows without a conv_id take no part.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    return rows.select(
        "conv_id", "turn", F.unhex(F.md5(F.concat(
            F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("mark"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def _run_within(group, adds, xors):
    """Running values within each group of sorted rows of one task, and the task's last row marked."""
    def run(batches):
        part, last, held, waiting = TaskContext.get().partitionId(), None, {}, None

        def marked(batch, tail):
            flags = np.zeros(batch.num_rows, bool)
            flags[-1] = tail
            return batch.append_column("part", pa.array(np.full(batch.num_rows, part), pa.int32())
                                       ).append_column("tail", pa.array(flags))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(group).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            lengths = np.diff(np.append(starts, len(keys)))
            goes_on = last is not None and keys[0] == last
            for name in (*adds, *xors):
                values = batch.column(name).to_numpy()
                total = (np.cumsum if name in adds else np.bitwise_xor.accumulate)(values)
                before = np.concatenate([[0], total])[starts]
                if name in adds:
                    total = total - np.repeat(before, lengths)
                    if goes_on:
                        total[:lengths[0]] += held[name]
                else:
                    total = total ^ np.repeat(before, lengths)
                    if goes_on:
                        total[:lengths[0]] ^= held[name]
                held[name] = total[-1]
                batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(
                    total, pa.int64()))
            last = keys[-1]
            if waiting is not None:
                yield marked(waiting, False)
            waiting = batch
        if waiting is not None:
            yield marked(waiting, True)
    return run


def running(rows, group, order, adds=(), xors=()):
    """Rows with the long columns ``adds`` and ``xors`` replaced by their running values.

    A group runs in the given order over as many tasks as the rows need: tasks take ranges, and one
    row per task tells the next what its first group has reached.
    """
    names = rows.columns
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    local = materialise(rows.repartitionByRange(group, *order).sortWithinPartitions(
        group, *order).mapInArrow(_run_within(group, adds, xors), schema + ", part int, tail boolean"),
        "running")
    first = {r["part"]: r["first"] for r in local.groupBy("part").agg(
        F.min(group).alias("first")).collect()}
    carried, now = [], None
    for r in local.where("tail").select("part", group, *adds, *xors).orderBy("part").collect():
        own = {n: r[n] for n in (*adds, *xors)}
        if now and now[0] == first[r["part"]]:
            carried.append((r["part"], now[0], *now[1].values()))
            if r[group] == now[0]:
                own = {n: v + now[1][n] if n in adds else v ^ now[1][n] for n, v in own.items()}
        now = (r[group], own)
    if not carried:
        return local.select(names)
    # One row per task at most.
    extra = local.sparkSession.createDataFrame(carried, ", ".join(
        ["part int", f"{group} long", *(f"`+{n}` long" for n in (*adds, *xors))]))
    joined = local.join(F.broadcast(extra), ["part", group], "left")
    return joined.select(*[
        (F.col(n) + F.coalesce(F.col(f"+{n}"), F.lit(0))).alias(n) if n in adds else
        F.col(n).bitwiseXOR(F.coalesce(F.col(f"+{n}"), F.lit(0))).alias(n) if n in xors else F.col(n)
        for n in names])


def ordered_turns(conversations):
    """(conv_id, pos, mark, words): turns numbered from 1 by turn, null first.

    Rows of one turn come in the order of the digest of their role and text.
    """
    rows = materialise(digests(conversations).withColumn("pos", F.lit(1).cast("long")), "digests")
    numbered = running(rows, "conv_id", ["turn", "mark"], adds=("pos",))
    turns = materialise(numbered.select("conv_id", "pos", "mark", "words"), "turns")
    discard(rows)
    return turns


def rebuilt_turns(turns, every=20, most=3):
    """Conversations rebuilt on the first turns of another, and all their ids.

    Conversation c takes the first h turns of conversation c - c % ``every``, fewer or none if that
    has no more, and then its own turns after its first h; h is crc32 of c as text, modulo ``most`` + 1.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1))
    base = F.col("conv_id") - F.col("conv_id") % every
    ids = turns.select("conv_id").distinct()
    heads = materialise(turns.where((base == F.col("conv_id")) & (F.col("pos") <= most)), "heads")
    held = heads.groupBy(F.col("conv_id").alias("base")).agg(F.max("pos").alias("held"))
    short = ids.select("conv_id", h.alias("h"), base.alias("base")).where("h > 0").join(
        held, "base", "left").select("conv_id", F.expr(
            "h - least(h, coalesce(held, 0))").alias("less")).where("less > 0")
    own = turns.where(F.col("pos") > h).join(short, "conv_id", "left").select(
        "conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "mark", "words")
    taken = ids.select("conv_id", h.alias("h"), base.alias("base")).where("h > 0").join(
        heads.withColumnRenamed("conv_id", "base"), "base").where("pos <= h").select(
        "conv_id", "pos", "mark", "words")
    return own.unionByName(taken), ids


def _letters(batches):
    """Hashes of place and turn, twice: once to run over, once to keep."""
    for batch in batches:
        place = finish(batch.column("pos").to_numpy().astype(np.uint64) * _STEP)
        marks = np.frombuffer(b"".join(batch.column("mark").to_pylist()), np.uint64).reshape(-1, 2)
        a, b = (pa.array(finish(marks[:, i] + finish(place + np.uint64(i + 1))).view(np.int64))
                for i in (0, 1))
        words = batch.column("words")
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("pos"), a, b, words,
                                          a, b, words],
                                         names=["conv_id", "pos", "ka", "kb", "w", "a", "b", "own"])


def prefix_keys(turns):
    """(conv_id, pos, ka, kb, w, ua, ub, own): keys of the prefix with and without the turn, its words
    so far and of the turn alone."""
    rows = turns.mapInArrow(_letters, "conv_id long, pos long, ka long, kb long, w long, a long, "
                                      "b long, own long")
    keys = running(rows, "conv_id", ["pos"], adds=("w",), xors=("ka", "kb"))
    return materialise(keys.select(
        "conv_id", "pos", "ka", "kb", "w", F.col("ka").bitwiseXOR(F.col("a")).alias("ua"),
        F.col("kb").bitwiseXOR(F.col("b")).alias("ub"), "own"), "keys")


# ------------------------------------------------------------------------------------- the trie

_NODES = "p long, e long, ea long, eb long, rep long, w long, f long, fa long, fb long, na long, " \
         "nb long, pa long, pb long, pw long"


def fattest(low, high):
    """SQL: the number in (low, high] that most powers of two divide."""
    bits = f"(length(bin(({low}) ^ ({high}))) - 1)"
    return f"shiftleft(shiftright({high}, {bits}), {bits})"


def along(keys, spans):
    """Rows of ``keys`` with ``p`` < pos <= ``e`` for spans (conv_id, p, e, ...) of conversations.

    Spans are cut into short ones first, so a conversation may have many and long ones.
    """
    cut = spans.withColumn("c", F.explode(F.expr(
        f"sequence(shiftright(p + 1, {COARSE}), shiftright(e, {COARSE}))"))).withColumn(
        "c", F.explode(F.expr(
            f"sequence(shiftright(greatest(p + 1, shiftleft(c, {COARSE})), {FINE}), "
            f"shiftright(least(e, shiftleft(c + 1, {COARSE}) - 1), {FINE}))")))
    return keys.withColumn("c", F.shiftright("pos", FINE)).join(cut, ["conv_id", "c"]).where(
        "pos > p and pos <= e").drop("c")


def locate(strings, nodes, keys, longest):
    """Where strings (conv_id, n) leave the trie: conv_id, n, p and the edge (rep, wp, we) they leave.

    The string follows the trie to the node at depth ``p`` at least; the edge is null where it leaves
    at the node itself.
    """
    handles = nodes.select("f", F.col("fa").alias("ka"), F.col("fb").alias("kb"), *(
        F.col(c).alias("t_" + c) for c in ("p", "e", "ea", "eb", "rep")))
    at = keys.select("conv_id", F.col("pos").alias("f"), "ka", "kb")
    zero = F.lit(0).cast("long")
    state = strings.select("conv_id", "n", zero.alias("low"), F.col("n").alias("high"), *(
        zero.alias("c_" + c) for c in ("p", "e", "ea", "eb", "rep")))
    found = None
    for _ in range(int(longest).bit_length()):
        probe = state.withColumn("f", F.expr(f"if(low < high, {fattest('low', 'high')}, null)"))
        hit = F.col("t_e").isNotNull()
        state = materialise(probe.join(at, ["conv_id", "f"], "left").join(
            handles, ["f", "ka", "kb"], "left").select(
            "conv_id", "n", F.when(hit, F.col("t_e")).otherwise(F.col("low")).alias("low"),
            F.when(hit | F.col("f").isNull(), F.col("high")).otherwise(F.col("f") - 1).alias("high"),
            *(F.when(hit, F.col("t_" + c)).otherwise(F.col("c_" + c)).alias("c_" + c)
              for c in ("p", "e", "ea", "eb", "rep"))), "probes")
        discard(*filter(None, [found]))
        found = state
    # Is the deepest node whose handle fits a prefix as a whole, and has it an edge that goes on?
    names = nodes.select(F.col("p").alias("c_e"), F.col("na").alias("ka"), F.col("nb").alias("kb"),
                         F.col("e").alias("w_e"), F.col("rep").alias("w_rep"))
    placed = state.withColumn("pos", F.expr("least(c_e + 1, n)")).join(
        keys.select("conv_id", "pos", "ka", "kb", "ua", "ub"), ["conv_id", "pos"]).withColumn(
        "whole", F.expr("c_e <= n and if(c_e < n, ua = c_ea and ub = c_eb, ka = c_ea and kb = c_eb)"))
    out = placed.join(names, ["c_e", "ka", "kb"], "left").selectExpr(
        "conv_id", "n", "if(whole, c_e, c_p) p",
        "if(whole, if(c_e < n, w_rep, null), c_rep) rep", "if(whole, c_e, c_p) wp",
        "if(whole, if(c_e < n, w_e, null), c_e) we")
    out = materialise(out, "located")
    discard(*filter(None, [found]))
    return out


def insert(nodes, strings, keys, longest):
    """The trie's nodes after the strings (conv_id, n) of a batch; ``nodes`` may be None."""
    if nodes is None:
        start, touched = strings.withColumn("p", F.lit(0).cast("long")), None
        below = keys.join(start, "conv_id").where("pos > p").withColumn("stop", F.expr("pos = n"))
    else:
        start = locate(strings, nodes, keys, longest)
        touched = start.where("we is not null").select(
            F.col("rep").alias("conv_id"), F.col("wp").alias("p"), F.col("we").alias("e")).distinct()
        below = keys.join(start.select("conv_id", "n", "p").where("p < n"), "conv_id").where(
            "pos > p").withColumn("stop", F.expr("pos = n")).drop("n").unionByName(
            along(keys, touched).withColumn("stop", F.expr("pos = e")).drop("e"))
    prefixes = materialise(below.groupBy("pos", "ka", "kb").agg(
        F.min("conv_id").alias("rep"), F.max("stop").alias("stop"), F.min("p").alias("p"),
        F.first("ua").alias("ua"), F.first("ub").alias("ub"), F.first("w").alias("w")), "prefixes")
    parted = prefixes.groupBy((F.col("pos") - 1).alias("pos"), F.col("ua").alias("ka"),
                              F.col("ub").alias("kb")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = prefixes.join(parted, ["pos", "ka", "kb"], "left").where("stop or n > 1")
    # The prefixes that one conversation stands for are a stretch of its path.  What is above its
    # first is a node or the end of the edge above, else the stretch would begin higher.
    begins = prefixes.groupBy("rep", "p").agg((F.min("pos") - 1).alias("above"))
    up = Window.partitionBy("rep", "p").orderBy("pos")
    kept = kept.withColumn("last", F.lag("pos").over(up)).join(begins, ["rep", "p"]).select(
        F.coalesce("last", "above").alias("p"), F.col("pos").alias("e"), F.col("ka").alias("ea"),
        F.col("kb").alias("eb"), "rep", "w").withColumn("f", F.expr(fattest("p", "e")))
    at = keys.select(F.col("conv_id").alias("rep"), "pos", "ka", "kb", "ua", "ub", "w", "own")
    new = kept.join(at.select("rep", F.col("pos").alias("f"), F.col("ka").alias("fa"),
                              F.col("kb").alias("fb")), ["rep", "f"]).join(
        at.select("rep", (F.col("pos") - 1).alias("p"), F.col("ka").alias("na"),
                  F.col("kb").alias("nb"), F.col("ua").alias("pa"), F.col("ub").alias("pb"),
                  (F.col("w") - F.col("own")).alias("pw")), ["rep", "p"])
    names = [c.split()[0] for c in _NODES.split(", ")]
    out = new.select(names)
    if touched is not None:
        gone = touched.select(F.col("conv_id").alias("rep"), "p", "e")
        out = out.unionByName(nodes.join(gone, ["rep", "p", "e"], "left_anti").select(names))
    out = materialise(out, "nodes")
    discard(prefixes)
    if nodes is not None:
        discard(nodes, start)
    return out


def build(keys, strings):
    """The compacted nodes below the root for strings (conv_id, n), n > 0, all different."""
    longest = strings.agg(F.max("n")).first()[0]
    if not longest:
        return None
    share = F.pmod(F.xxhash64("conv_id"), F.lit(BATCHES[-1]))
    nodes, before = None, 0
    for end in BATCHES:
        batch = strings.where((share >= before) & (share < end))
        before = end
        if not batch.isEmpty():
            nodes = insert(nodes, batch, keys, longest)
    return nodes


# ---------------------------------------------------------------------- sums, ends, expansion

def _subtree_sums(nodes, sums):
    """Nodes (id, up, low, sums...) with each sum, and the least ``low``, over all nodes below.

    In round k every node knows its sums over the nodes less than 2^k below it and its ancestor 2^k
    above; ``up`` is null below the root.
    """
    now = nodes
    while not now.where("up is not null").isEmpty():
        sent = now.where("up is not null").groupBy(F.col("up").alias("id")).agg(
            F.min("low").alias("+low"), *(F.sum(c).alias("+" + c) for c in sums))
        above = now.where("up is not null").select(F.col("id").alias("up"), F.col("up").alias("next"))
        then = materialise(now.join(sent, "id", "left").join(above, "up", "left").select(
            "id", F.col("next").alias("up"), F.least("low", "+low").alias("low"),
            *((F.col(c) + F.coalesce(F.col("+" + c), F.lit(0))).alias(c) for c in sums)), "sums")
        if now is not nodes:
            discard(now)
        now = then
    return now


def _pieces(batches):
    """Ids of sorted rows joined by commas, in pieces of one class each."""
    key, ids = None, []

    def piece():
        return pa.RecordBatch.from_arrays(
            [pa.array([k]) for k in key] + [pa.array([ids[0]]), pa.array([",".join(map(str, ids))])],
            names=["n", "ka", "kb", "first", "piece"])

    for batch in batches:
        for *own, conv_id in zip(*(batch.column(c).to_pylist() for c in ("n", "ka", "kb", "conv_id"))):
            if key is not None and (own != key or len(ids) >= PIECE):
                yield piece()
                ids = []
            key = own
            ids.append(conv_id)
    if ids:
        yield piece()


def _hash_pieces(batches):
    """SHA-256 of each class's pieces in order, joined by commas; only the hash is held."""
    key, state, done = None, None, []

    def flush():
        rows = list(zip(*done))
        done.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in rows[:3]),
                                           pa.array(rows[3], pa.string())],
                                          names=["n", "ka", "kb", "sha"])

    for batch in batches:
        for *own, piece in zip(*(batch.column(c).to_pylist() for c in ("n", "ka", "kb", "piece"))):
            if own != key:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                    if len(done) >= 5000:
                        yield flush()
                key, state = own, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
    if state is not None:
        done.append((*key, state.hexdigest()))
    if done:
        yield flush()


def _end_hashes(ends):
    by = ["n", "ka", "kb"]
    pieces = ends.select(*by, "conv_id").repartitionByRange(*by, "conv_id").sortWithinPartitions(
        *by, "conv_id").mapInArrow(_pieces, "n long, ka long, kb long, first long, piece string")
    return pieces.repartition(*by).sortWithinPartitions(*by, "first").mapInArrow(
        _hash_pieces, "n long, ka long, kb long, sha string")


def trie_nodes(turns, ids):
    """One row per distinct prefix of turns (conv_id, pos, mark, words) of the conversations ``ids``.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.  ``pos`` counts from 1 without gaps.  Conversations without turns end at the root.
    """
    keys = prefix_keys(turns)
    zero = F.lit(0).cast("long")
    last = keys.groupBy("conv_id").agg(F.max(F.struct("pos", "ka", "kb", "w")).alias("x"))
    ends = materialise(ids.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("x.pos", zero).alias("n"), F.coalesce("x.ka", zero).alias("ka"),
        F.coalesce("x.kb", zero).alias("kb"), F.coalesce("x.w", zero).alias("w")), "ends")
    classes = materialise(ends.groupBy("n", "ka", "kb").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("members"),
        F.max("w").alias("w")).join(_end_hashes(ends), ["n", "ka", "kb"], "left"), "classes")
    spark = ids.sparkSession
    nodes = build(keys, classes.where("n > 0").select("conv_id", "n"))
    nodes = spark.createDataFrame([], _NODES) if nodes is None else nodes
    nodes = materialise(nodes.withColumn("id", F.monotonically_increasing_id()), "numbered")

    kids = nodes.groupBy(F.col("p").alias("e"), F.col("pa").alias("ea"), F.col("pb").alias("eb")).agg(
        F.count(F.lit(1)).alias("kids"))
    parents = nodes.select(F.col("id").alias("up"), F.col("e").alias("p"), F.col("ea").alias("pa"),
                           F.col("eb").alias("pb"))
    here = classes.select(F.col("n").alias("e"), F.col("ka").alias("ea"), F.col("kb").alias("eb"),
                          F.col("conv_id").alias("low"), "members", F.col("w").alias("end_w"), "sha")
    linked = materialise(nodes.join(kids, ["e", "ea", "eb"], "left").join(
        parents, ["p", "pa", "pb"], "left").join(here, ["e", "ea", "eb"], "left").select(
        "id", "up", "rep", "p", "e", "pw", "low", "sha", F.coalesce("kids", zero).alias("kids"),
        F.coalesce("members", zero).alias("n_convs"),
        F.when(F.col("kids").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        # Words that members read in all, and words of the distinct turns: their difference is saved.
        F.coalesce(F.col("members") * F.col("end_w"), zero).alias("read"),
        (F.col("w") - F.col("pw")).alias("held")), "linked")
    sums = ["n_convs", "n_leaves", "read", "held"]
    own = linked.select("id", "up", "low", *sums)
    total = _subtree_sums(own, sums)
    empty_sha = hashlib.sha256(b"").hexdigest()

    root_own = classes.where("n = 0")
    tops = linked.agg(*(F.coalesce(F.sum(c), zero).alias(c) for c in sums),
                      F.coalesce(F.sum(F.expr("if(p = 0, 1, 0)")), zero).alias("n_children")).first()
    end = root_own.first()
    low = ids.agg(F.min("conv_id")).first()[0]
    if low is None:
        return spark.createDataFrame([], _RESULT)
    root = spark.createDataFrame([(
        low, 0, None, tops["n_convs"] + (end["members"] if end else 0), tops["n_children"],
        tops["n_leaves"] if tops["n_children"] else 1, tops["read"] - tops["held"],
        end["sha"] if end else empty_sha)], _RESULT)

    lows = total.select(F.col("id").alias("up"), F.col("low").alias("up_low"))
    full = linked.select("id", "up", "rep", "p", "e", "pw", "kids", "sha").join(
        total.drop("up"), "id").join(lows, "up", "left")
    rows = along(keys.select("conv_id", "pos", "w", "own"),
                 full.withColumnRenamed("rep", "conv_id").withColumn(
                     "up_low", F.coalesce("up_low", F.lit(low))))
    before = F.col("w") - F.col("own")
    rows = rows.select(
        F.col("low").alias("conv_id"), F.col("pos").alias("depth"),
        F.expr("if(pos = p + 1, up_low, low)").alias("parent_conv_id"), "n_convs",
        F.expr("if(pos = e, kids, 1L)").alias("n_children"), "n_leaves",
        (F.col("read") - F.col("n_convs") * before - F.col("held") + before - F.col("pw")
         ).alias("saved_tokens"),
        F.expr(f"if(pos = e, coalesce(sha, '{empty_sha}'), '{empty_sha}')").alias("ends_sha256"))
    return rows.unionByName(root)


_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, " \
          "n_leaves long, saved_tokens long, ends_sha256 string"


def conversation_trie(conversations):
    """``trie_nodes`` of conversations as they are: rows (conv_id, turn, role, text).

    Turns come by ``turn``, null first, then by a digest of role and text; repeated rows are further
    turns.  Null roles and texts are empty.  Rows without a conv_id take no part, further columns are
    ignored, and an empty table gives no rows.
    """
    turns = ordered_turns(conversations)
    return trie_nodes(turns, turns.select("conv_id").distinct())


def rebuilt_trie(conversations):
    """``trie_nodes`` of the conversations that ``rebuilt_turns`` makes; rows as above."""
    turns, ids = rebuilt_turns(ordered_turns(conversations))
    return trie_nodes(turns, ids)


SQL = r"""
with turns as materialized (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, md5(
      length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as i
  from conversations where conv_id is not null),
ids as materialized (
  select conv_id, conv_id - conv_id % 20 as base, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295) % 4 as h
  from (select distinct conv_id, hex(encode(conv_id::varchar)) as x from turns)),
held as (select conv_id as base, count(*) as held from turns group by all),
rebuilt as materialized (
  select ids.conv_id, i as pos, role, text from ids join turns on turns.conv_id = base and i <= h
  union all
  select ids.conv_id, i - h + least(h, coalesce(held, 0)), role, text
  from ids join turns using (conv_id) left join held on held.base = ids.base where i > h),
paths as materialized (
  select conv_id, pos as d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words,
         list(md5(length(role)::varchar || ':' || role || text)) over (
           partition by conv_id order by pos) as path from rebuilt
  union all select conv_id, 0, 0, [] from ids),
nodes as materialized (
  select d, path, min(conv_id) as conv_id, count(*) as n, any_value(words) as words
  from paths group by d, path),
lengths as (select conv_id, max(d) as d from paths group by conv_id),
ends as (
  select p.d, p.path, string_agg(p.conv_id::varchar, ',' order by p.conv_id) as members
  from paths p join lengths using (conv_id, d) group by p.d, p.path),
kids as (select d - 1 as d, path[:-2] as path, count(*) as kids from nodes where d > 0 group by all),
own as materialized (
  select nodes.*, coalesce(kids, 0) as kids from nodes left join kids using (d, path)),
below as (
  select p.d, p.path, sum((o.n - 1) * o.words) as saved, count(*) filter (o.kids = 0) as leaves
  from own o join paths p on p.conv_id = o.conv_id and p.d <= o.d group by p.d, p.path)
select o.conv_id, o.d::bigint as depth, u.conv_id as parent_conv_id, o.n::bigint as n_convs,
       o.kids::bigint as n_children, b.leaves::bigint as n_leaves, b.saved::bigint as saved_tokens,
       sha256(coalesce(e.members, '')) as ends_sha256
from own o join below b using (d, path) left join ends e using (d, path)
left join own u on u.d = o.d - 1 and u.path = o.path[:-2]
"""
