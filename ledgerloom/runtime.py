"""What every operator needs from the session: tables, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of a side that is broadcast; a larger side is joined by shuffle.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read in full; Catalyst pushes columns and filters into the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that ``stage`` wrote and that are still there.
_STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset a local session makes one, which ends with it; a cluster cannot do without."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return context._jsc.sc().getCheckpointDir().get()


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder of any file system Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> int:
    """Deletes what ``stage`` wrote so far; frames read from it must no longer be used. Runs by itself when the program ends."""
    done = 0
    while _STAGED:
        with contextlib.suppress(Exception):  # a session that has ended cannot delete; its folder is the cluster's to clear
            done += remove(spark, _STAGED.pop())
    return done


def _release_last() -> None:
    spark = SparkSession.getActiveSession() if _STAGED else None
    if spark is not None:
        release(spark)


atexit.register(_release_last)


def cut(df: DataFrame) -> DataFrame:
    """The frame with its lineage cut by a reliable checkpoint that outlives the loss of an executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, *partition_by: str) -> DataFrame:
    """The frame written to the shared folder as parquet and read back (columns prune on later reads)."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"stage-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    _STAGED.append(path)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``rows`` rows; reads no more than one row beyond the bound."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame marked for broadcast if it has at most ``rows`` rows, else left to a shuffle join."""
    return F.broadcast(df) if is_small(df, rows) else df


def parallelism(spark: SparkSession) -> int:
    """Partitions for repartitioned work: the session's shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
