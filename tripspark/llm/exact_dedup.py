"""Exact deduplication by sorting contents.

Sampled splitters deal the normalised texts to ranges of their bytes; each range is sorted outside
memory, which places equal texts side by side, and the sorted neighbours are compared in full.  Of
a run of equal texts the smallest doc_id stays.

A text with very many copies would fill one range.  Texts with more than 1/65536 of all rows, of
which there are at most 65,536, are cut into runs by a hash of the doc_id, which is part of the sort
key; one row of each run then takes part in a second sort that joins the runs of equal text.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..sources.shared import materialise

#: Runs of equal texts are cut from this share of all rows on; also the most texts that are cut.
SHARES = 65_536
LEAST_RUN = 256
#: Splitters are sampled from so many first characters, and a hash where these are equal: the sample
#: goes to the driver, and whole texts would make it grow with their length.
SPLITTER = 48


def normalised(text):
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(documents):
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space is one space; null is empty.
    Exactly one row of a group is kept: the one with the smallest doc_id, any one of rows that
    repeat it.  Null ids come last: keep_id is null only if the whole group has none.
    """
    docs = documents.select("doc_id", normalised(F.col("text")).alias("norm"))
    digest = F.xxhash64("norm")
    limit = max(LEAST_RUN, -(-documents.count() // SHARES))
    # At most SHARES texts have so many copies: rows / limit <= SHARES.
    large = docs.groupBy(digest.alias("digest")).count().where(F.col("count") > limit).select(
        "digest", F.ceil(F.col("count") / limit).alias("cuts"))
    cut = docs.join(F.broadcast(large), F.xxhash64("norm") == F.col("digest"), "left").select(
        "doc_id", "norm", F.substring("norm", 1, SPLITTER).alias("front"),
        F.xxhash64("norm").alias("mark"), F.col("cuts").isNotNull().alias("large"),
        F.coalesce(F.expr("pmod(xxhash64(doc_id), cuts)"), F.lit(0)).alias("cut"))

    # The ranges keep equal keys together, so the windows need no further shuffle.
    own = Window.partitionBy("front", "mark", "norm", "cut")
    first = own.orderBy(F.col("doc_id").asc_nulls_last())
    runs = cut.repartitionByRange("front", "mark", "cut").select(
        "doc_id", "cut", "large", F.row_number().over(first).alias("nth"),
        F.min("doc_id").over(own).alias("run_id"),
        F.count(F.lit(1)).over(own).alias("run_size"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "norm")
    runs = materialise(runs.withColumn("norm", F.expr("if(large and nth = 1, norm, null)")), "runs")

    same = Window.partitionBy("norm")
    # One row for each cut of a large text: at most 2 * SHARES rows of five short columns.
    joined = runs.where("large and nth = 1").select(
        "text_sha256", "cut", F.min("run_id").over(same).alias("all_id"),
        F.sum("run_size").over(same).alias("all_size"),
        (F.row_number().over(same.orderBy(F.col("run_id").asc_nulls_last())) == 1).alias("wins"))
    return runs.join(F.broadcast(joined), ["text_sha256", "cut"], "left").select(
        "doc_id", F.when(F.col("large"), F.col("all_id")).otherwise(F.col("run_id")).alias(
            "keep_id"), F.coalesce("all_size", "run_size").alias("group_size"),
        ((F.col("nth") == 1) & F.coalesce("wins", F.lit(True))).alias("kept"), "text_sha256")


SQL = r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
  from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id,
       count(*) over (partition by norm) as group_size,
       row_number() over (partition by norm order by doc_id nulls last) = 1 as kept,
       sha256(norm) as text_sha256
from texts
"""
