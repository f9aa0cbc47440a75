"""Writers.  Paths are the caller's; on a cluster they must lie in a shared file system."""

from pyspark.sql import DataFrame, functions as F

from ..operators.cleaning import clean_text


def write_parquet(df: DataFrame, path, codec="snappy") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def write_small_csv(df: DataFrame, path, sep=",", sort=()) -> None:
    """One CSV file with a header, for report tables of bounded size only.

    The rows are gathered by a shuffle, so the work that produces them keeps its parallelism.
    """
    single = df.repartition(1)
    if sort:
        single = single.sortWithinPartitions(*sort)
    single.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_csv(df: DataFrame, path, sep=",", codec="none") -> None:
    """Any number of CSV files with headers."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("compression", codec).csv(path))


def write_dual(df: DataFrame, parquet_path, csv_path=None, sort=(), small=False) -> None:
    """Parquet, and optionally CSV made from the Parquet just written.

    ``small`` promises a report of bounded size, which becomes one file in the order of ``sort``.
    """
    write_parquet(df, parquet_path)
    if csv_path:
        written = df.sparkSession.read.parquet(parquet_path)
        if small:
            write_small_csv(written, csv_path, sort=sort)
        else:
            write_csv(written, csv_path)


def write_tsv(df: DataFrame, path) -> None:
    """Tab-separated text in any number of files, every value on one line."""
    write_csv(clean_text(df), path, sep="\t")


def write_json(df: DataFrame, path) -> None:
    """JSON lines; ML vectors become arrays."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT
    vectors = [f.name for f in df.schema if isinstance(f.dataType, VectorUDT)]
    df.withColumns({v: vector_to_array(F.col(v)) for v in vectors}).write.mode(
        "overwrite").json(path)


def write_variant(df: DataFrame, path, fmt, codec, files=None, spread=True) -> None:
    """One format and codec; ``files`` fixes the number of files at the price of a shuffle.

    A table that is read as it is needs no ``spread``: where it has partitions enough, as many
    tasks as files read and write it without a shuffle.
    """
    if files is None:
        shaped = df
    elif spread or df.rdd.getNumPartitions() < files:
        shaped = df.repartition(files)
    else:
        shaped = df.coalesce(files)
    writer = shaped.write.mode("overwrite").option("compression", codec)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
