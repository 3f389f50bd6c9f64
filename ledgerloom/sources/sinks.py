"""Sinks: idempotent reload by filing, serving copies, long exports, registry upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import remove, stage


def reload(df: DataFrame, path: str, partition: str = "doc_id", check: Callable[[DataFrame], DataFrame] | None = None, touched: DataFrame | None = None) -> None:
    """Replaces only the partitions of ``df``, after ``check`` (violations of the frame) came out empty.

    ``touched`` (column ``partition``) are the partitions that are loaded anew, of which ``df`` may have no rows any more:
    what they had before goes. The frame is computed once. A second run with the same rows leaves the same table.
    """
    df = stage(df)
    if check is not None and (bad := check(df).limit(5).collect()):
        raise ValueError(f"not written, violations: {bad}")
    df.repartition(F.col(partition)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    if touched is not None:
        spark = df.sparkSession
        name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        emptied = touched.select(F.col(partition).cast("string")).distinct().join(df.select(F.col(partition).cast("string")).distinct(), partition, "left_anti")
        for row in emptied.toLocalIterator():
            remove(spark, f"{path}/{name(partition, row[0])}")


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``columns`` (name -> type) of the frame, in that order; those it lacks are null, others are left out."""
    have = set(df.columns)
    return df.select(*[(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in columns.items()])


def sync(frames: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Writes every frame over its serving copy; a frame that fails does not hold up the others. Returns what happened to each."""
    done = {}
    for name, df in frames.items():
        try:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            done[name] = "written"
        except Exception as e:  # noqa: BLE001
            done[name] = f"failed: {type(e).__name__}"
    return done


def export_long(cells: DataFrame, path: str) -> None:
    """One filing's cells as long CSV, in printed order."""
    cells.orderBy("doc_id", "table_id", "row_id", "col_id").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def seed_registry(old: DataFrame, new: DataFrame, keys: list[str], answer: str = "table_type_id") -> DataFrame:
    """The registry with new entries; what a person has confirmed (source human_confirmed) is never overwritten."""
    b = new.select(*keys, F.col(answer).alias("__new"), F.col("source").alias("__source"))
    both = old.join(b, keys, "full_outer")
    keep = (F.col("source") == "human_confirmed") | F.col("__new").isNull()
    return both.select(*keys, F.when(keep, F.col(answer)).otherwise(F.col("__new")).alias(answer), F.when(keep, F.col("source")).otherwise(F.col("__source")).alias("source"))


