"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens, raised to an exponent and normalised.  The exponent
is bisected so that the weights have a given entropy, or so that no source is repeated more often
than a limit.  Each source's documents fall into a fixed number of blocks; every epoch takes the
blocks in a permutation of its own, and the last epoch stops where the source's budget ends.

Sources are rows of a table like others, however many there are.  For an entropy or a budget each
round of the bisection is one aggregate over them that tries many exponents at once; without a
budget the smallest and the largest source decide.  Documents are never moved to be ordered, except
those of the one block of each source in which its budget ends.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.shared import materialise

BLOCKS = 1024
#: Exponents tried by one aggregate, and aggregates; together they cut an interval to 2^-60 of it.
TRIED = 63
ROUNDS = 10
#: Rows of the block plan (sources x blocks x epochs) that may be broadcast; about 50 bytes each.
BROADCAST_ROWS = 400_000
MIX_COLUMNS = "mix_source mix_tokens mix_block mix_epoch mix_weight mix_passes mix_slot".split()


def token_count(text):
    """Words between ASCII white space; a null text has none."""
    words = F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def weights(tokens, exponent):
    """Normalised weights of sources with these token counts; empty sources weigh nothing."""
    total = sum(tokens.values())
    raw = {s: (t / total) ** exponent if t else 0.0 for s, t in tokens.items()}
    norm = math.fsum(raw.values())
    return {s: w / norm for s, w in raw.items()}


def entropy(shares):
    return -math.fsum(p * math.log(p) for p in shares.values() if p)


def passes(tokens, shares, budget):
    """How often each source is read; without a budget, the least repeated one exactly once."""
    rate = {s: shares[s] / t for s, t in tokens.items() if t}
    if budget is None:
        budget = 1 / min(rate.values())
    return {s: budget * r for s, r in rate.items()}


def _bisect(ok, low, high):
    """The smallest exponent in [low, high] for which ``ok`` holds; ``ok`` is monotone."""
    if ok(low):
        return low
    if not ok(high):
        return high
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if ok(middle) else (middle, high)
    return high


def solve_exponent(tokens, target_entropy=None, repetition_limit=None, budget=None, highest=16.0):
    """The smallest exponent whose entropy is at most, or whose repetitions are within, the target.

    A target out of reach gives the nearest end of [0, highest]: 0 for an entropy above that of
    equal weights, ``highest`` for one below what it reaches; 1 for a limit below any repetition,
    since equal rates are the least that a budget allows.
    """
    held = {s: t for s, t in tokens.items() if t}
    if len(held) < 2:
        return 1.0
    if target_entropy is not None:
        return _bisect(lambda a: entropy(weights(held, a)) <= target_entropy + 1e-12, 0.0, highest)
    limit = math.inf if repetition_limit is None else repetition_limit
    return _bisect(lambda a: max(passes(held, weights(held, a), budget).values())
                   <= limit * (1 + 1e-12), 0.0, 1.0)


def _seeded(seed, *columns):
    return F.xxhash64(F.lit(seed), *columns)


def _search(ok, low, high):
    """``_bisect`` for a test of many exponents at a time; ``ok`` takes and returns a list."""
    first, last = ok([low, high])
    if first or not last:
        return low if first else high
    for _ in range(ROUNDS):
        step = (high - low) / (TRIED + 1)
        tried = [low + step * (i + 1) for i in range(TRIED)]
        good = ok(tried)
        at = good.index(True) if True in good else TRIED
        low, high = ([low, *tried][at], [*tried, high][at])
    return high


def table_exponent(sources, target_entropy=None, repetition_limit=None, budget=None, highest=16.0):
    """``solve_exponent`` for a table with a column ``tokens``, one row per source.

    Returns (exponent, all tokens, normaliser, rate): a source of t tokens weighs
    (t / all) ** exponent / normaliser, and is read rate * weight / t times.
    """
    held = sources.where("tokens > 0").select(F.col("tokens").cast("double").alias("t"))
    facts = held.agg(F.sum("t"), F.min("t"), F.max("t"), F.count("t")).first()
    total, least, most, number = facts
    if not number:
        return 1.0, 1.0, 1.0, 0.0
    share = F.col("t") / F.lit(total)

    def sums(exponents):
        """[(sum of powers, entropy)] of the sources' weights at each exponent."""
        found = held.agg(*[x for a in exponents for x in (
            F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share)))]).first()
        return [(norm, math.log(norm) - a * logs / norm)
                for a, norm, logs in zip(exponents, found[::2], found[1::2])]

    if number < 2:
        exponent = 1.0
    elif target_entropy is not None:
        exponent = _search(lambda tried: [h <= target_entropy + 1e-12 for _, h in sums(tried)],
                           0.0, highest)
    elif budget is None:
        # Rates differ most between the smallest and the largest source.
        exponent = solve_exponent({"least": least, "most": most}, None, repetition_limit)
    else:
        limit = math.inf if repetition_limit is None else repetition_limit
        exponent = _search(lambda tried: [
            budget * (least / total) ** a / norm / least <= limit * (1 + 1e-12)
            for a, (norm, _) in zip(tried, sums(tried))], 0.0, 1.0)
    norm = sums([exponent])[0][0]
    rate = budget
    if budget is None:
        rate = max(t * norm / (t / total) ** exponent for t in (least, most))
    return exponent, total, norm, float(rate)


def _plan(docs, seed, **target):
    """(block plan, boundary): which blocks of which source are read in which epoch, and when."""
    totals = materialise(docs.groupBy("mix_source", "mix_block").agg(
        F.sum("mix_tokens").alias("block_tokens")), "blocks")
    sources = materialise(totals.groupBy("mix_source").agg(
        F.sum("block_tokens").alias("tokens")), "sources")
    exponent, total, norm, rate = table_exponent(sources, **target)
    tokens = F.col("tokens").cast("double")
    often = F.when(F.col("tokens") > 0, F.lit(rate) * F.col("mix_weight") / tokens).otherwise(
        F.lit(1.0))  # sources without words are read once
    # Written, so that retries agree on the last digits.
    plan = materialise(sources.withColumn("mix_weight", F.when(
        F.col("tokens") > 0, F.pow(tokens / F.lit(total), F.lit(exponent)) / F.lit(norm)).otherwise(
        F.lit(0.0))).withColumn("mix_passes", often).withColumn(
        "mix_whole", F.floor(F.col("mix_passes") + 1e-9).cast("long")).select(
        "mix_source", F.col("tokens").alias("mix_all"), "mix_weight", "mix_passes", "mix_whole",
        F.expr("if(mix_passes - mix_whole > 1e-9D, (mix_passes - mix_whole) * tokens, 0.0D)").alias(
            "mix_part")), "weights")
    order = Window.partitionBy("mix_source", "mix_epoch").orderBy(
        _seeded(seed, "mix_source", "mix_block", "mix_epoch"), "mix_block").rowsBetween(
        Window.unboundedPreceding, -1)
    epochs = totals.join(plan, "mix_source").withColumn(
        "mix_epoch", F.explode(F.expr("sequence(0L, mix_whole)"))).withColumn(
        "mix_before", F.coalesce(F.sum("block_tokens").over(order), F.lit(0)))
    # The epoch after the whole ones is read up to its part of the source.
    epochs = epochs.where("mix_epoch < mix_whole or mix_before < mix_part").withColumn(
        "mix_rest", F.expr(
        "if(mix_epoch = mix_whole and mix_before + block_tokens > mix_part, "
        "mix_part - mix_before, null)"))
    return materialise(epochs.select(
        "mix_source", "mix_block", "mix_epoch", "mix_rest", "mix_weight", "mix_passes",
        F.expr("if(mix_all = 0, 0.0D, (mix_epoch * mix_all + mix_before) / "
               "(mix_passes * mix_all))").alias("mix_slot")), "plan")


def mix(documents, seed=17, target_entropy=None, repetition_limit=2.0, budget=None):
    """All columns of ``documents`` plus mix_source, mix_tokens, mix_block, mix_epoch, mix_weight,
    mix_passes and mix_slot; input columns of such names are replaced.

    One row per reading of a document.  ``mix_slot`` in [0, 1) says when: ordered by it, every
    prefix holds the sources in about their weights.  ``budget``: tokens to read; without it every document
    is read at least once and sources are repeated up to ``repetition_limit``.  With
    ``target_entropy`` (nats) the weights have that entropy and the limit does not count.

    A null source is the source ''.  Sources without words are read once.  The document in which a
    budget ends is read whole.  Rows that repeat a doc_id are documents of their own.
    """
    docs = documents.drop(*[c for c in documents.columns if c.startswith("mix_")]).select(
        "*", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("mix_source"),
        token_count(F.col("text")).alias("mix_tokens"),
        F.pmod(_seeded(seed, "doc_id"), F.lit(BLOCKS)).alias("mix_block"))
    sizes = materialise(docs.select("doc_id", "mix_source", "mix_tokens", "mix_block"), "sizes")
    plan = _plan(sizes, seed, target_entropy=target_entropy,
                 repetition_limit=None if target_entropy is not None else repetition_limit,
                 budget=budget)
    whole = plan.where("mix_rest is null").drop("mix_rest")
    ends = plan.where("mix_rest is not null")
    if plan.count() <= BROADCAST_ROWS:
        whole, ends = F.broadcast(whole), F.broadcast(ends)
    first = docs.join(whole, ["mix_source", "mix_block"])
    # One block of a source at most: its documents in order, until the budget ends.
    order = Window.partitionBy("mix_source").orderBy(
        _seeded(seed + 1, "doc_id", "mix_epoch"), "doc_id", "mix_tokens").rowsBetween(
        Window.unboundedPreceding, -1)
    last = docs.join(ends, ["mix_source", "mix_block"]).withColumn(
        "mix_ahead", F.coalesce(F.sum("mix_tokens").over(order), F.lit(0))).where(
        "mix_ahead < mix_rest")
    return first.unionByName(last.drop("mix_ahead", "mix_rest")).select(
        *[c for c in documents.columns if not c.startswith("mix_")], *MIX_COLUMNS)


def mixture(documents, **target):
    """The readings without the texts: doc_id, source, n_tokens, epoch, block, slot, weight."""
    mixed = mix(documents.select("doc_id", "text", "source"), **target)
    return mixed.select("doc_id", *[F.col(f"mix_{old}").alias(new) for old, new in (
        ("source", "source"), ("tokens", "n_tokens"), ("epoch", "epoch"), ("block", "block"),
        ("slot", "slot"), ("weight", "weight"))])
