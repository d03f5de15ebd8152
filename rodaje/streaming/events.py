"""Windowed counts over a stream of events, with late rows bounded by a watermark and repeated ones dropped."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rodaje.session import ensure_checkpoint_dir


def windowed(events: DataFrame, at: str = "ts", id_col: str = "event_id", kind: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Per window and kind: n and total. Rows later than `late` behind the newest are dropped; an id counts once within that span."""
    seen = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([id_col])
    return seen.groupBy(F.window(at, width), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total")).select(
        F.col("window.start").alias("desde"), F.col("window.end").alias("hasta"), kind, "n", "total"
    )


def run_once(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Process everything available, write finished windows to a folder all executors share, and read them back."""
    spark: SparkSession = stream.sparkSession
    ensure_checkpoint_dir(spark)
    base = path or f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/state")
        .option("path", f"{base}/out").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def upsert_latest(batch: DataFrame, target: DataFrame | None, keys: list[str], order: str) -> DataFrame:
    """The newest row per key of what is stored and what has arrived; for use in foreachBatch."""
    both = batch if target is None else target.unionByName(batch, allowMissingColumns=True)
    newest = F.max(F.struct(F.col(order), *[F.col(c) for c in both.columns if c not in (*keys, order)])).alias("_r")
    return both.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in both.columns if c not in keys])


def run_upserts(stream: DataFrame, keys: list[str], order: str, path: str | None = None) -> DataFrame:
    """Process everything available, keeping the newest row per key; every batch writes its own version of the table.

    A batch that runs again after a failure starts from the version before it and replaces its own, so a row counts once.
    """
    spark: SparkSession = stream.sparkSession
    ensure_checkpoint_dir(spark)
    base = path or f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/upserts-{uuid.uuid4().hex}"
    schema = stream.schema
    last = {"version": -1}

    def write(batch: DataFrame, number: int) -> None:
        target = batch.sparkSession.read.schema(schema).parquet(f"{base}/v{number - 1}") if number else None
        upsert_latest(batch, target, keys, order).select(*schema.names).write.mode("overwrite").parquet(f"{base}/v{number}")
        last["version"] = number

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/v{last['version']}") if last["version"] >= 0 else spark.createDataFrame([], schema)


def sessions(stream: DataFrame, key: str, at: str, gap_seconds: int) -> DataFrame:
    """key, events, sessions: running totals per key; a session ends when nothing is seen for `gap_seconds`.

    The state of a key is two counts and the time of its last event. Events of a key are expected in the order of their batches; within one
    they are sorted. Rows without key or time are left out.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, count, last = state.get if state.exists else (0, 0, 0.0)
        seen = np.sort(np.concatenate([f["_s"].to_numpy() for f in frames]))
        before = np.concatenate([[last if n else -np.inf], seen[:-1]])
        n, count = n + len(seen), count + int((seen - before > gap_seconds).sum())
        state.update((n, count, float(max(seen[-1], last) if n > len(seen) else seen[-1])))
        yield pd.DataFrame({key: [k[0]], "events": [n], "sessions": [count]})

    rows = stream.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, F.unix_micros(F.col(at).cast("timestamp")).alias("_u"))
    rows = rows.select(key, (F.col("_u") / 1e6).alias("_s"))
    kind = dict(rows.dtypes)[key]
    return rows.groupBy(key).applyInPandasWithState(
        step, f"`{key}` {kind}, events long, sessions long", "n long, sessions long, last double", "update", GroupStateTimeout.NoTimeout
    )


def run_updates(stream: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Process everything available of a stream of running totals; the last row per key, where `order` only grows."""
    spark: SparkSession = stream.sparkSession
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/updates-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/lote={number}")

    query = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    told = spark.read.schema(stream.schema).parquet(f"{base}/out/*")
    return upsert_latest(told, None, keys, order).select(*stream.schema.names)
