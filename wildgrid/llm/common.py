"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words in the contracts: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset a local session
    (tests) takes a temporary folder of this machine; any other is refused, as its
    executors would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Spark's setting by which a query's shuffle files go when it ends, not when their frames are collected.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of an Arrow batch that a Python task is given at most.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """``df`` as a Parquet table of the shared folder: cuts lineage, outlives executors, and frees its shuffles' disk.

    ``batch``: rows of an Arrow batch at most while it is written, for wide rows.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    put = {_CLEAN: "true"} | ({_BATCH: str(batch)} if batch else {})
    before = {k: spark.conf.get(k) for k in put}
    for k, v in put.items():
        spark.conf.set(k, v)
    try:
        # planned anew, so that the settings hold
        df.select("*").write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def forget(*tables: DataFrame) -> None:
    """Deletes what ``written`` has written, once nothing reads it any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def lower_ascii(column):
    """A-Z lower-cased; all other characters stay."""
    return F.translate(column, UPPER, LOWER)


def broadcast_checked(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only after counting: beyond ``rows`` the join stays a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
