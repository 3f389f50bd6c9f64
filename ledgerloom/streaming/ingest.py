"""Streams: extraction units loaded batch by batch, events in windows with late data, sessions with their own state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerloom.operators.load import build_star
from ledgerloom.runtime import stage
from ledgerloom.sources.sinks import reload


def ingest_units(spark: SparkSession, source: str, schema: str, filings: DataFrame, target: str, checkpoint: str, members: DataFrame | None = None) -> StreamingQuery:
    """Loads micro-batches of units (parquet with unit_id, doc_id, tables) into the fact table under ``target``.

    Units are kept under ``target``/units, one folder a batch, and a batch loads its filings anew from all their units so
    far, of which the last delivered counts: a filing may come in any number of batches, in any order, and a batch that is
    run again does no harm. Filings that a reload leaves without facts or warnings lose the old ones.
    ``members`` (axes.member_map) tells which axis members labels name.
    """

    def load(batch: DataFrame, number: int) -> None:
        batch.select("unit_id", "doc_id", "tables").withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{target}/units")
        kept = spark.read.parquet(f"{target}/units")
        touched = stage(kept.where(F.col("batch") == number).select("doc_id").distinct())
        units = kept.join(touched, "doc_id", "left_semi").groupBy("unit_id").agg(F.max_by(F.struct("doc_id", "tables"), "batch").alias("u")).select("unit_id", "u.*")
        star = build_star(stage(units), filings, {"cell_fact", "load_warning"}, members)
        reload(star["cell_fact"], f"{target}/cell_fact", touched=touched)
        reload(star["load_warning"], f"{target}/load_warning", touched=touched)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Events (ts, event_type, value) counted and summed by window and type; events later than ``late`` are left out."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    counts = events.withWatermark("ts", late).groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    return counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "events", "total")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Events (ts, user_id) in sessions that end after ``gap`` without one."""
    sessions = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("events"))
    return sessions.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events")


def repeated_status(events: DataFrame) -> DataFrame:
    """(user_id, event_type, attempts, escalated): status of each user after every batch; an immediate repeat escalates."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, attempts, escalated = state.get if state.exists else (None, 0, False)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for kind in rows["event_type"]:
            escalated = kind == last
            attempts = attempts + 1 if escalated else 1
            last = kind
        state.update((last, attempts, bool(escalated)))
        yield pd.DataFrame({"user_id": [key[0]], "event_type": [last], "attempts": [attempts], "escalated": [bool(escalated)]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, event_type string, attempts long, escalated boolean", "last string, attempts long, escalated boolean", "update", GroupStateTimeout.NoTimeout)
