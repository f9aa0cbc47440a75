"""File-level facts: sizes, and row and column counts of CSV files."""

from pyspark.sql import DataFrame, SparkSession, functions as F

TOTAL = "__TOTAL__"
_MB = 1024 * 1024


def _decoded(column):
    """A path without the escapes of its URI form; a plus sign is no escape there."""
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))


def _files(spark, root):
    """(file_path, length) of all files below a path."""
    # Only path and length are selected, so no file content is read.
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    sized = found.select(F.col("path").alias("file_path"), "length")
    # A scan skips empty files.  Only if there are any do names pass through the driver.
    if len(found._jdf.inputFiles()) == sized.count():
        return sized
    listed = spark.createDataFrame([(p,) for p in found.inputFiles()], "p string").select(
        _decoded(F.col("p")).alias("p"))
    listed = listed.select(_plain("p").alias("plain"), "p")
    return (listed.join(sized.withColumn("plain", _plain("file_path")), "plain", "left")
            .select(F.coalesce("file_path", "p").alias("file_path"),
                    F.coalesce("length", F.lit(0)).alias("length")))


def _plain(column):
    """Path without the scheme of the local file system, whose number of slashes varies."""
    return F.regexp_replace(column, "^file:/+", "/")


def path_size(spark: SparkSession, root) -> DataFrame:
    """Total bytes and MB of all files below a path, from the file system's own summary."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    summary = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path)
    total = F.lit(summary.getLength()).cast("long")
    return spark.range(1).select(total.alias("size_bytes"),
                                 F.round(total / _MB, 3).alias("size_mb"))


def csv_shape(spark: SparkSession, root, sep=",", multiline=False) -> DataFrame:
    """Per CSV file: data rows and header fields, in one pass.

    By default a record is a line, so that large files are split among tasks.  With ``multiline``
    quoted line breaks belong to their field, and a file is read by one task.
    """
    everywhere = {"recursiveFileLookup": True, "pathGlobFilter": "*.[cC][sS][vV]"}
    if multiline:
        # The parser decides where records end; it hands over whole records of several fields.
        lines = spark.read.options(**everywhere).csv(
            root, schema="value string, _whole string", sep=sep, multiLine=True,
            mode="PERMISSIVE", columnNameOfCorruptRecord="_whole").withColumn(
            "value", F.coalesce("_whole", "value"))
    else:
        lines = spark.read.options(**everywhere).text(root)
    lines = lines.select(_decoded(F.col("_metadata.file_path")).alias("file_path"),
                         F.col("_metadata.file_block_start").alias("start"), "value",
                         F.monotonically_increasing_id().alias("line"))
    # The header is the first line of the split that starts at byte 0.
    header = F.min_by(F.when(F.col("start") == 0, F.col("value")),
                      F.when(F.col("start") == 0, F.col("line")))
    unquoted = F.regexp_replace("header", '"[^"]*"', "q")
    return (lines.groupBy("file_path").agg((F.count("*") - 1).alias("rows"),
                                           header.alias("header"))
            .select("file_path", "rows",
                    F.size(F.split(unquoted, "\\Q" + sep + "\\E")).alias("columns")))


def file_audit(spark: SparkSession, root, sep=",", multiline=False) -> DataFrame:
    """Per file: path, name, extension, MB, and for CSV rows and columns; then a total row.

    ``multiline`` as in ``csv_shape``.
    """
    name = F.element_at(F.split("file_path", "/"), -1)
    extension = F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]+)$", 1))
    files = _files(spark, root).select(
        "file_path", name.alias("file_name"), extension.alias("extension"),
        F.round(F.col("length") / _MB, 3).alias("size_mb"))
    plain = _plain("file_path")
    shapes = csv_shape(spark, root, sep, multiline).select(plain.alias("plain"), "rows", "columns")
    listed = (files.withColumn("plain", plain).join(shapes, "plain", "left").drop("plain")
              .withColumn("rows", F.when((F.col("extension") == ".csv"),
                                         F.coalesce("rows", F.lit(0))))
              .withColumn("columns", F.when((F.col("extension") == ".csv"),
                                            F.coalesce("columns", F.lit(0)))))
    total = listed.agg(F.lit(TOTAL).alias("file_path"), F.lit(TOTAL).alias("file_name"),
                       F.lit("").alias("extension"),
                       F.round(F.sum("size_mb"), 3).alias("size_mb"),
                       F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                       F.lit(None).cast("int").alias("columns"))
    # Spreadsheets are not opened; the column keeps the layout of the published table.
    return listed.unionByName(total).withColumn("excel_sheets", F.lit(None).cast("string"))
