"""Profiles of any set of tables, as DataFrames.

Each operator takes ``{name: DataFrame}``.  Per table there is one aggregate over all columns,
turned into one row per column by ``unpivot``.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.derive import safe_ratio
from ..functions.text import literal, quoted
from .quantiles import ACCURACY, clean_double, column_quantiles, exact_quantiles

PROBABILITIES = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


def _stack(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _fields(df, kind):
    return [f.name for f in df.schema if isinstance(f.dataType, kind)]


def _named(df, table):
    return df.select(F.lit(table).alias("table_name"), "*")


def overview(tables: dict, paths: dict | None = None) -> DataFrame:
    """Table, row count, column count and path."""
    paths = paths or {}
    return _stack(
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"),
               F.lit(len(df.columns)).alias("column_count"),
               F.lit(paths.get(name, "")).alias("hdfs_path"))
        for name, df in tables.items())


def table_counts(tables: dict) -> DataFrame:
    return _stack(df.agg(F.lit(name).alias("table_name"), F.count("*").alias("records_count"))
                  for name, df in tables.items())


def column_types(tables: dict, details=False) -> DataFrame:
    """Table, column and type; with ``details`` also nullability and ordinal position."""
    rows = [(name, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO", i)
            for name, df in tables.items() for i, f in enumerate(df.schema, 1)]
    spark = next(iter(tables.values())).sparkSession
    out = spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, is_nullable string, "
              "ordinal_position int")
    return out if details else out.drop("is_nullable", "ordinal_position")


def missing_values(tables: dict) -> DataFrame:
    """Per column: rows, missing values and their percentage; NaN counts as missing."""
    def one(name, df):
        floating = set(_fields(df, (T.FloatType, T.DoubleType)))
        tests = {c: f"{quoted(c)} is null" + (f" or isnan({quoted(c)})" if c in floating else "")
                 for c in df.columns}
        counts = df.selectExpr("count(*) as __rows", *[
            f"count_if({test}) as {quoted(c)}" for c, test in tests.items()])
        return _named(counts.unpivot(["__rows"], list(map(quoted, df.columns)), "column_name",
                                     "null_count"), name)
    percent = F.coalesce(F.round(safe_ratio(100 * F.col("null_count"), "total_rows"), 4),
                         F.lit(0.0))
    return (_stack(one(n, d) for n, d in tables.items())
            .withColumnRenamed("__rows", "total_rows")
            .select("table_name", "column_name", "total_rows", "null_count",
                    percent.alias("null_pct")))


_STATISTICS = {"non_null_count": "count", "mean": "avg", "stddev": "stddev",
               "variance": "variance", "min": "min", "max": "max"}


def numeric_summary(tables: dict) -> DataFrame:
    """Per numeric column: count, mean, sample deviation and variance, minimum and maximum."""
    def one(name, df):
        columns = _fields(df, T.NumericType)
        clean = df.selectExpr(*[f"{clean_double(c)} as c{i}" for i, c in enumerate(columns)])
        flat = clean.selectExpr(*[
            "struct(" + ", ".join(f"{fn}(c{i}) as {s}" for s, fn in _STATISTICS.items())
            + f") as c{i}" for i in range(len(columns))])
        entries = ", ".join(f"struct({literal(c)} as column_name, c{i}.*)"
                            for i, c in enumerate(columns))
        return _named(flat.selectExpr(f"inline(array({entries}))"), name)
    return _stack(one(n, d) for n, d in tables.items() if _fields(d, T.NumericType))


def numeric_quantiles(tables: dict, exact=False, accuracy=ACCURACY) -> DataFrame:
    """Per numeric column with values: five quantiles, each an element of the column."""
    outputs, wanted = list(PROBABILITIES), list(PROBABILITIES.values())
    numeric = {name: _fields(df, T.NumericType) for name, df in tables.items()}
    numeric = {name: columns for name, columns in numeric.items() if columns}
    if exact:
        return exact_quantiles({name: (tables[name], columns) for name, columns in numeric.items()},
                               wanted, outputs, accuracy)
    return _stack(_named(column_quantiles(tables[n], c, wanted, outputs, accuracy=accuracy), n)
                  for n, c in numeric.items())


def categorical_summary(tables: dict, exact=False) -> DataFrame:
    """Per string column: the number of distinct values."""
    def one(name, df):
        columns = _fields(df, T.StringType)
        if exact:
            # Texts are compared by digest, so that long ones need not be shuffled.
            values = df.selectExpr(*[
                f"unhex(sha2({q}, 256)) as {q}" for q in map(quoted, columns)])
            values = values.unpivot([], list(map(quoted, columns)), "column_name", "v")
            # A column without values must still be listed.
            counted = (values.groupBy("column_name", "v").agg(F.lit(1).alias("one"))
                       .groupBy("column_name").agg(F.count("v").alias("approx_distinct_count")))
            every = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
            out = (every.join(counted, "column_name", "left")
                   .select("column_name",
                           F.coalesce("approx_distinct_count", F.lit(0).cast("long"))
                           .alias("approx_distinct_count")))
        else:
            flat = df.selectExpr(*[f"approx_count_distinct({q}) as {q}"
                                   for q in map(quoted, columns)])
            out = flat.unpivot([], list(map(quoted, columns)), "column_name",
                               "approx_distinct_count")
        return _named(out, name)
    return _stack(one(n, d) for n, d in tables.items() if _fields(d, T.StringType))


def group_summary(df: DataFrame, group="feature_group", item="feature_name") -> DataFrame:
    """Items per group."""
    return df.groupBy(group).agg(F.count(item).alias("features_count"))
