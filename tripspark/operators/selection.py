"""Feature selection and the train/test split, computed on the cluster."""

from pyspark.sql import DataFrame, Window, functions as F

from .. import schema as S
from . import cleaning
from .quantiles import column_quantiles, quantile_trim

METHOD = "SelectKBest_mutual_info_regression"
KEPT = "kept_for_spark_string_indexing"


def modelling_rows(trips: DataFrame, target=S.TARGET, low=0.01, high=0.99,
                   exact=True) -> DataFrame:
    """Trips fit for modelling: positive target within its quantile bounds, plausible trip."""
    names = cleaning.existing_columns(trips, [*S.NUMERIC_CANDIDATES, target])
    clean = cleaning.positive_target(cleaning.nan_to_null(trips, names), target)
    return cleaning.plausible_trips(quantile_trim(clean, target, low, high, exact))


def impute_medians(df: DataFrame, features, exact=False) -> DataFrame:
    """Fill NULLs of each feature with its median; an all-NULL feature stays NULL."""
    medians = column_quantiles(df, features, [0.5], ["median"], exact)
    # One entry per feature: the map is as small as the feature list.
    entries = medians.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "median"))))
    # Held in one column, so that the plan contains the subquery once and not per feature.
    return (df.withColumn("_medians", entries.scalar())
            .withColumns({c: F.expr(f"coalesce({c}, element_at(_medians, '{c}'))")
                          for c in features})
            .drop("_medians"))


def mutual_information(df: DataFrame, features=None, target=S.TARGET, bins=32,
                       exact=False) -> DataFrame:
    """Mutual information in nats of each binned feature with the binned target.

    Missing values take the feature's median.  Feature and target are cut into ``bins``
    equal-width bins; one shuffle carries at most bins² counts per feature.  A constant feature
    scores 0 and an all-NULL feature scores NULL.  ``n_rows`` is the number of rows used.
    """
    names = list(features or cleaning.existing_columns(df, S.NUMERIC_CANDIDATES))
    filled = impute_medians(df.where(F.col(target).isNotNull()).selectExpr(
        *[f"cast({c} as double) as {c}" for c in names],
        f"cast({target} as double) as _y"), names, exact)
    columns = [*names, "_y"]
    spans = filled.selectExpr("struct(" + ", ".join(
        f"struct(min({c}) as lo, max({c}) as hi) as {c}" for c in columns) + ") as s")

    def binned(c):
        lo, hi = f"_span.{c}.lo", f"_span.{c}.hi"
        inner = f"least(floor(({c} - {lo}) / ({hi} - {lo}) * {bins}), {bins - 1})"
        return f"cast(case when {hi} > {lo} then {inner} when {hi} = {lo} then 0 end as int) as {c}"

    cells = (filled.withColumn("_span", spans.scalar()).selectExpr(*map(binned, columns))
             .unpivot(["_y"], names, "feature", "x")
             .groupBy("feature", "x", "_y").agg(F.count("*").alias("n")))
    return _score(cells)


def _score(cells):
    def total(*keys):
        return F.sum("n").over(Window.partitionBy("feature", *keys))
    known = F.col("x").isNotNull()
    marginals = cells.withColumns({"n_all": total(), "n_x": total("x"), "n_y": total("_y")})
    term = F.col("n") / F.col("n_all") * F.ln(
        F.col("n") * F.col("n_all") / (F.col("n_x") * F.col("n_y")))
    return marginals.groupBy("feature").agg(
        F.sum(F.when(known, term)).alias("score"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_rows"))


def feature_rank(scores: DataFrame, score="score", name="feature") -> DataFrame:
    """Rank by score, best first, equal scores by name, NULL last.

    Scores are sums of floating-point terms, so they count as equal when nine decimals agree.
    """
    # The table has one row per feature, so one window partition is enough.
    w = Window.partitionBy(F.lit(0)).orderBy(F.round(score, 9).desc_nulls_last(), name)
    return scores.withColumn("rank", F.row_number().over(w))


def select_k_best(scores: DataFrame, k=S.SELECT_K) -> DataFrame:
    """Rank all numeric features and mark the k best that have a score."""
    chosen = (F.col("rank") <= k) & F.col("score").isNotNull()
    return feature_rank(scores).select(
        "feature", F.lit("numeric").alias("feature_type"), "score", "rank",
        chosen.cast("int").alias("selected"), F.lit(METHOD).alias("selection_method"))


def keep_categorical(df: DataFrame, features=tuple(S.CATEGORICAL_FEATURES)) -> DataFrame:
    """Categorical features in the layout of ``select_k_best``: always kept, without a score."""
    names = cleaning.existing_columns(df, features)
    rows = df.sparkSession.createDataFrame([(n,) for n in names], "feature string")
    return rows.select("feature", F.lit("categorical").alias("feature_type"),
                       F.lit(None).cast("double").alias("score"),
                       F.lit(None).cast("int").alias("rank"), F.lit(1).alias("selected"),
                       F.lit(KEPT).alias("selection_method"))


def feature_selection(df: DataFrame, target=S.TARGET, k=S.SELECT_K, bins=32,
                      exact=False) -> DataFrame:
    """The selection report: ranked numeric features and the kept categorical ones."""
    scores = mutual_information(df, target=target, bins=bins, exact=exact)
    return select_k_best(scores, k).unionByName(keep_categorical(df))


def selected_names(report: DataFrame) -> tuple:
    """(numeric names in rank order, categorical names) of a selection report.

    Collects the report, which has one row per feature.
    """
    rows = report.where("selected = 1").collect()
    numeric = sorted((r for r in rows if r["feature_type"] == "numeric"), key=lambda r: r["rank"])
    return ([r["feature"] for r in numeric],
            [r["feature"] for r in rows if r["feature_type"] == "categorical"])


def prepare(df: DataFrame, numeric, categorical, target=S.TARGET, keys=tuple(S.TRIP_KEYS)):
    """Model table: keys for the split, selected features and the label."""
    keys = cleaning.existing_columns(df, keys)
    return df.select(*keys, *numeric, *categorical, F.col(target).alias(S.LABEL))


def split_bucket(keys, seed=S.SEED, buckets=100):
    """Bucket of a row from the digest of its key and the seed."""
    text = F.concat_ws("_", *keys, F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(buckets))


def split_train_test(df: DataFrame, ratio=S.TRAIN_RATIO, seed=S.SEED,
                     keys=tuple(S.TRIP_KEYS)) -> tuple:
    """(train, test).

    With keys, membership depends only on a row's key, so it survives retries, repartitioning
    and more data.  With ``keys=None`` rows are drawn by ``randomSplit``, which depends on the
    partitioning and must be materialised before use.
    """
    if keys is None:
        train, test = df.randomSplit([ratio, 1.0 - ratio], seed=seed)
        return train, test
    bucket = split_bucket(keys, seed, 10000)
    return df.where(bucket < round(ratio * 10000)), df.where(bucket >= round(ratio * 10000))


def split_metadata(train: DataFrame, test: DataFrame, train_path="", test_path="") -> DataFrame:
    """Rows, columns and path of both parts."""
    def one(name, df, path):
        return df.agg(F.lit(name).alias("dataset"), F.count("*").alias("row_count"),
                      F.lit(len(df.columns)).alias("columns_count"),
                      F.lit(path).alias("hdfs_path"))
    return one("train", train, train_path).unionByName(one("test", test, test_path))
