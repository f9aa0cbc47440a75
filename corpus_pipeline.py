"""From raw documents to token files: the stages, in order, over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns what it kept, with the columns of documents; the
last returns one row per document, read back from the token files.
"""

import public_tokenizers
from pyspark.sql import functions as F

from tripspark.llm import decontaminate, jaccard_join, mixing, token_files, toxicity
from tripspark.llm.common import read_table, rows_without_ids, share_package
from tripspark.sources.shared import discard, materialise


#: The number of a row within a stage; no table has such a column.
ROW = "pipeline row number"


def whole_rows(spark):
    """Keep Arrow batches small from here on: stages return whole rows that pass through Python.

    A stage's result is computed when it is written, so the session keeps the setting.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= 1000:
        spark.conf.set(name, "1000")


def numbered(docs):
    """The rows with a number each that the stage's decisions go by.

    Where every row has a doc_id of its own that is the number.  Else the rows are written once with
    numbers, so that retries agree.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).groupBy("id").count()
    if ids.where("id is null or count > 1").isEmpty():
        return docs.withColumn(ROW, F.col("doc_id").cast("long"))
    return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def by_number(rows):
    """Numbered rows as the operators take them: the number is the doc_id."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def without_rows(rows, gone):
    """Rows whose number is not among ``gone`` (one column, doc_id), without their numbers."""
    own = [c for c in rows.columns if c != ROW]
    kept = rows_without_ids(rows.withColumnsRenamed({"doc_id": "own id", ROW: "doc_id"}), gone)
    return kept.drop("doc_id").withColumnRenamed("own id", "doc_id").select(own)


def drop_toxic(spark, docs, sf_dir):
    """Rows that the classifier, learnt from all labelled rows, does not reject."""
    whole_rows(spark)
    return toxicity.without_toxic(docs, docs, read_table(spark, sf_dir, "labels"))


def one_of_each_group(spark, docs, sf_dir):
    """Of rows linked by n-gram Jaccard similarity, the one with the smallest doc_id.

    Five words and 0.8, as near-duplicate stages take.  Rows without a doc_id go before those that
    have one; of equal ids one row stays.  Rows without words link with nothing and stay.
    """
    share_package(spark)
    whole_rows(spark)
    rows = numbered(docs)
    found = materialise(jaccard_join.jaccard_components(by_number(rows), percent=80, width=5),
                        "groups")
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    # The ids of what is linked; only these decide.
    linked = materialise(found.join(several, "component_id").select("component_id", "doc_id").join(
        rows.select(F.col(ROW).alias("doc_id"), F.col("doc_id").alias("own")), "doc_id"), "linked")
    first = linked.groupBy("component_id").agg(F.min(F.struct(
        F.col("own").isNull(), "own", "doc_id"))["doc_id"].alias("first"))
    return without_rows(rows, materialise(
        linked.join(first, "component_id").where("doc_id <> first").select("doc_id"), "copies"))


def drop_benchmark(spark, docs, sf_dir):
    """Rows that overlap with no benchmark item."""
    whole_rows(spark)
    rows = numbered(docs)
    found = decontaminate.overlaps(by_number(rows), read_table(spark, sf_dir, "benchmark"))
    return without_rows(rows, materialise(found.select("doc_id"), "leaks"))


def mix_sources(spark, docs, sf_dir):
    """Every document once, small sources up to twice; a row for each reading."""
    return mixing.mix(docs).select(docs.columns)


def token_output(spark, docs, sf_dir):
    """Token files in order of doc_id; one row per reading, read back from the files."""
    share_package(spark)
    return token_files.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


#: (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", token_output),
]
#: No SQL can state the classifier and the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages; each is written as Parquet and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name)
        discard(before)  # what a stage has read goes as soon as its result is written
    tokens = STAGES[-1][1](spark, docs, sf_dir)
    discard(docs)  # the token files are written
    return tokens
