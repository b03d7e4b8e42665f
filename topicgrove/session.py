"""Session settings and the written tables that cut long lineages."""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def local_session(app: str = "topicgrove", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: what the cluster names in spark.checkpoint.dir.

    Only a local master gets a folder of its own when the setting is absent; a
    cluster without one is refused, since a lost executor would take the only
    copy of a machine-local file with it.
    """
    context = spark.sparkContext
    named = spark.conf.get(SHARED_DIR_KEY, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"Set {SHARED_DIR_KEY} to a folder that all executors share.")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="topicgrove-"))
    return context.getCheckpointDir()


def one_thread_each(spark: SparkSession) -> None:
    """Let matrix products in Python workers use one thread: tasks fill the cores already, and more threads wait for each other.

    A number that the application has set for its workers is kept.
    """
    spark.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")


def written_dir(spark: SparkSession) -> str:
    """Where this application's tables lie."""
    return f"{shared_dir(spark)}/topicgrove/{spark.sparkContext.applicationId}"


def drop_written(spark: SparkSession) -> None:
    """Delete every table that this application has written with ``written``.

    For the end of a job, when its results have been saved elsewhere: DataFrames over the tables cannot be read after it.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(written_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a DataFrame over the files.

    Used where a loop would grow its lineage, or where a plan would compute an
    expensive input twice. The file size gives Spark exact statistics, so later
    joins broadcast the table only when it really is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffle otherwise.
    """
    spark = df.sparkSession
    path = f"{written_dir(spark)}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def folders(table: DataFrame) -> list[str]:
    """The folders that the files of a table from ``written`` lie in."""
    return sorted({unquote(f.rsplit("/", 1)[0]) for f in table.inputFiles()})


def written_and_measured(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``written`` with aggregates of the rows that are gathered while they are written."""
    seen = Observation()
    table = written(df.observe(seen, *[m.alias(key) for key, m in metrics.items()]), name)
    return table, seen.get
