"""Where intermediate tables live: the shared folder named by the session."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Fallback folders by application; the setting itself cannot be changed in a running session.
_FALLBACK: dict = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.

    Only a local master may fall back to a temporary folder: on a cluster that would be a
    different folder on every machine.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _FALLBACK:
        _FALLBACK[application] = tempfile.mkdtemp(prefix="tripspark-")
    return _FALLBACK[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tripspark/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name="table") -> DataFrame:
    """Write the table to the shared folder and read it back.

    Cuts the lineage: later stages that lose an executor reread the files instead of repeating
    the work behind them, and every reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote; nothing may read them any more."""
    for table in tables:
        path = getattr(table, "scratch", None)
        if path:
            spark = table.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give the iterative learners a checkpoint folder if the session has none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
