"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; everything else, whatever its label, is unlabelled.  The
risk of a linear classifier is estimated from both and the class prior: the unlabelled texts count
as negatives, less the positives' share among them, and that difference is kept from going below
zero.

Features are the words of a text and the first five bytes of each, hashed, present or not.  Document
frequencies over all learning rows choose those that positives hold more often than texts at large;
only the weights are fitted on a bounded sample.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from ..sources.shared import materialise
from .common import (ARRAY_SCHEMA, WORDS, add_arrays, array_rows, crc_bucket, rows_with_ids,
                     text_slices, tidy)

BITS = 18
SIZE = 2 << BITS  # words, then beginnings of words
BEGINNING = 5
#: Features that may get a weight.
CHOSEN = 4096
#: The bounded sample for fitting: confirmed and unlabelled texts, taken by a hash of the id.
POSITIVES, UNLABELLED = 8_000, 32_000
STEPS, RATE, DECAY = 400, 0.05, 1e-4


def _features(texts):
    """(features, index of the text) of the distinct features of each text."""
    words, counts = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = set(text.translate(WORDS).split())
        counts[i] = len(own)
        words += own
    mask = (1 << BITS) - 1
    whole = np.fromiter((xxhash.xxh3_64_intdigest(w) & mask for w in words), np.int64, len(words))
    begin = np.fromiter((xxhash.xxh3_64_intdigest(w[:BEGINNING], 1) & mask for w in words),
                        np.int64, len(words)) + (1 << BITS)
    text = np.repeat(np.arange(len(texts)), counts)
    return np.concatenate([whole, begin]), np.concatenate([text, text])


def _distinct(feature, text):
    key = np.unique(text * SIZE + feature)
    return key % SIZE, key // SIZE


def _frequencies(batches):
    """Texts per feature, and at last the number of texts."""
    out = np.zeros(SIZE + 1, np.int64)
    for ids, texts in text_slices(batches):
        out[:SIZE] += np.bincount(_distinct(*_features(texts))[0], minlength=SIZE)
        out[SIZE] += len(ids)
    if out.any():
        yield array_rows(out, 32)


def _sampled(chosen):
    """The chosen features of each text."""
    def run(batches):
        place = chosen.value
        for _, texts in text_slices(batches):
            feature, text = _features(texts)
            keep = place[feature] >= 0
            feature, text = _distinct(place[feature[keep]], text[keep])
            offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature))],
                names=["features"])
    return run


def choose_features(positive, everything):
    """Features that positives hold clearly more often, by a z score; -1 for all others."""
    n, m = max(1, positive[SIZE]), max(1, everything[SIZE])
    p, u = positive[:SIZE] / n, everything[:SIZE] / m
    z = (p - u) / np.sqrt(np.maximum(u * (1 - u), 1 / m) / n)
    order = np.argsort(-z, kind="stable")[:CHOSEN]
    order = order[(z[order] > 3) & (positive[order] >= 3)]
    place = np.full(SIZE, -1, np.int64)
    place[order] = np.arange(len(order))
    return place, order


def fit(positive, unlabelled, prior, size):
    """Weights and bias by the non-negative risk; each sample is (features, index of text, texts).
    """
    weights, bias = np.zeros(size), np.log(prior / (1 - prior))
    samples = [positive, unlabelled]
    moments = [np.zeros(size + 1), np.zeros(size + 1)]
    for step in range(1, STEPS + 1):
        scores, logistic = [], []
        for feature, text, n in samples:
            score = bias + np.bincount(text, weights[feature], n)
            scores.append(score)
            logistic.append(1 / (1 + np.exp(-np.clip(score, -30, 30))))
        (p, u), (sp, su) = logistic, scores
        # Logistic loss; as a negative, its derivative is the logistic itself.
        rest = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        if rest >= 0:
            slopes = [prior * ((p - 1) - p) / len(p), u / len(u)]
        else:  # the corrected part fell below zero: step back along it alone
            slopes = [prior * p / len(p), -u / len(u)]
        slope = np.zeros(size + 1)
        for (feature, text, _), d in zip(samples, slopes):
            slope[:size] += np.bincount(feature, d[text], size)
            slope[size] += d.sum()
        slope[:size] += DECAY * weights
        for k, (rate, value) in enumerate(((0.9, slope), (0.999, slope * slope))):
            moments[k] = rate * moments[k] + (1 - rate) * value
        move = RATE * (moments[0] / (1 - 0.9 ** step)) / (
            np.sqrt(moments[1] / (1 - 0.999 ** step)) + 1e-8)
        weights -= move[:size]
        bias -= move[size]
    return weights, bias


def _gather(rows):
    lists = rows.toArrow().column("features").combine_chunks()
    n = len(lists)
    sizes = np.diff(np.asarray(lists.offsets)) if n else np.zeros(0, np.int64)
    return np.asarray(lists.flatten()).astype(np.int64), np.repeat(np.arange(n), sizes), n


def train(documents, labels):
    """Dense weights over all features, and the bias.

    ``documents`` (doc_id, text) are the learning rows, ``labels`` (doc_id, toxic) theirs.  Without
    any positive the classifier says 0 for every text; a document with several labels is toxic if
    one says so.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    known = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    if not prior:
        return np.zeros(SIZE, np.float32), -30.0
    prior = min(prior, 0.99)
    positives = rows_with_ids(docs, known.where("toxic > 0").select("doc_id"), iter, docs.schema)
    everything = add_arrays(docs.mapInArrow(tidy(_frequencies), ARRAY_SCHEMA))
    positive = add_arrays(positives.mapInArrow(tidy(_frequencies), ARRAY_SCHEMA))
    if positive is None or everything is None:
        return np.zeros(SIZE, np.float32), -30.0
    place, order = choose_features(positive, everything)
    chosen = spark.sparkContext.broadcast(place)

    def sample(df, held, most):
        # A share by a hash of the id; nine tenths of the bound, which is then kept exactly.
        share = min(1.0, 0.9 * most / max(1, held))
        part = df.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000))
                        < int(share * 1_000_000)) if share < 1 else df
        return _gather(part.mapInArrow(tidy(_sampled(chosen)), "features array<long>").limit(most))

    p = sample(positives, int(positive[SIZE]), POSITIVES)
    u = sample(docs, int(everything[SIZE]), UNLABELLED)
    if not p[2] or not u[2]:
        return np.zeros(SIZE, np.float32), -30.0
    weights, bias = fit(p, u, prior, len(order))
    dense = np.zeros(SIZE, np.float32)
    dense[order] = weights
    return dense, float(bias)


def _scores(texts, weights, bias):
    feature, text = _features(texts)
    keep = weights[feature] != 0
    feature, text = _distinct(feature[keep], text[keep])
    score = bias + np.bincount(text, weights[feature], len(texts))
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def _score(model):
    def run(batches):
        weights, bias = model.value
        for ids, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(_scores(texts, weights, bias))],
                names=["doc_id", "score"])
    return run


def _keep(model, id_name, text_name):
    """Whole rows whose text scores below 0.5."""
    def run(batches):
        weights, bias = model.value
        for batch in batches:
            if batch.num_rows:
                score = np.concatenate([_scores(texts, weights, bias) for _, texts in text_slices(
                    [batch], id_name, text_name)])
                yield batch.filter(pa.array(score < 0.5))
    return run


def toxicity_scores(documents, training, labels):
    """One row per row of ``documents``: doc_id, score in (0, 1), predicted (1 from 0.5 on).

    A null text is empty; empty texts get the bias alone.  Scores depend on the text only.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(training, labels))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(tidy(_score(model)), "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(documents, training, labels):
    """The rows of ``documents``, all columns, whose text is not predicted to be toxic.

    Each row is judged by its own text, so ids may be null or repeated.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(training, labels))
    return documents.mapInArrow(tidy(_keep(model, "doc_id", "text")), documents.schema)


def held_out_scores(documents, labels, folds=5):
    """Scores of all rows, learnt from rows whose crc32(doc_id) mod ``folds`` is not 0."""
    def learn(df):
        return df.where(crc_bucket(F.col("doc_id"), folds) != 0)

    scores = toxicity_scores(documents, learn(documents), learn(labels))
    return scores.select("doc_id", (crc_bucket(F.col("doc_id"), folds) == 0).alias("held_out"),
                         "score", "predicted")
