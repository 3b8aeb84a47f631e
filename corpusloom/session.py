"""Session helpers: the local session used by tests and bench, and shared scratch folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "corpusloom", memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Where the setting is absent, as in tests, a folder in the warehouse is set, which is shared as well.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch")
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared folder.

    All of an application's scratch lies in one folder, which its file system removes when the driver ends.
    """
    context = spark.sparkContext
    run = f"{shared_dir(spark)}/corpusloom-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(run)
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{run}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the frame once to the shared folder and read it back.

    For a frame several later passes read: each pass scans only its own columns, and a lost executor
    recomputes nothing before this point. The copy lives until ``discard`` or the end of the application.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._scratch = path
    return kept


def discard(*frames: DataFrame) -> None:
    """Delete the copies behind frames that ``materialize`` returned and nothing reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
