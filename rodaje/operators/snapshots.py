"""What changed between full snapshots of a table, by windows over each key's snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def changes(snapshots: DataFrame, key: str, snapshot: str, values: Sequence[str]) -> DataFrame:
    """key, snapshot, change: 'alta', 'baja' or 'cambio' of each key against the snapshot before.

    Snapshots are numbered by date; a gap in a key's numbers is a removal after its last and an addition at its next,
    and between neighbouring numbers a differing hash of the values is a change. Null is a value of its own. A key given
    twice in one snapshot counts once, with its least values (null first) if they differ. Rows without key or date are
    left out, and so is the first snapshot, which has none before it. Rows are reduced to one per key and snapshot before
    anything is ordered, so a key has at most as many rows in a task as there are snapshots.
    """
    rows = snapshots.select(F.col(key).cast("string").alias("key"), F.col(snapshot).alias("at"), F.struct(*values).alias("v")).where(
        "key is not null and at is not null"
    )
    once = rows.groupBy("key", "at").agg(F.xxhash64(F.to_json(F.min("v"))).alias("h"))
    # One row per snapshot: as many as there are deliveries.
    dates = rows.select("at").distinct()
    order = W.orderBy("at")
    dates = dates.select("at", F.row_number().over(order).alias("i"), F.lead("at").over(order).alias("after"))
    own = W.partitionBy("key").orderBy("i")
    seen = once.join(dates, "at").select(
        "key", "at", "i", "after", "h", F.lag("i").over(own).alias("i0"), F.lag("h").over(own).alias("h0"), F.lead("i").over(own).alias("i1")
    )
    follows = F.coalesce(F.col("i0") == F.col("i") - 1, F.lit(False))
    event = lambda when, at, what: F.when(when, F.struct(at.alias("snapshot"), F.lit(what).alias("change")))
    events = F.array(
        event(~follows & (F.col("i") > 1), F.col("at"), "alta"),
        event(follows & (F.col("h") != F.col("h0")), F.col("at"), "cambio"),
        event(F.col("after").isNotNull() & F.coalesce(F.col("i1") > F.col("i") + 1, F.lit(True)), F.col("after"), "baja"),
    )
    return seen.select("key", F.explode(F.array_compact(events)).alias("e")).select("key", "e.snapshot", "e.change")


def latest(snapshots: DataFrame, keys: Sequence[str], snapshot: str) -> DataFrame:
    """The rows of each key's newest snapshot, ties included."""
    newest = F.max(snapshot).over(W.partitionBy(*keys))
    return snapshots.withColumn("_newest", newest).where(F.col(snapshot) == F.col("_newest")).drop("_newest")
