"""Session and table access shared by every query."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC time; callers may override any setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset, a local one in local mode (tests), an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        known = spark.sparkContext.getCheckpointDir()
        if not known and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = known or "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        if not known:
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and lost executors lose nothing.

    The shuffle files of the write go when it ends, as nothing reads them again; a
    stage that is retried after that makes them anew.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage/{label}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete a table of ``stage_table`` that no later read needs."""
    files = staged.inputFiles()
    if not files:
        return
    folder = files[0].rsplit("/", 1)[0]
    if folder.rsplit("/", 2)[1] != "stage":
        raise ValueError(f"not a staged table: {folder}")
    path = staged.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(staged.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` set to ``value`` for what runs inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_batches(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what runs inside: wide rows then stay within a worker's memory."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
