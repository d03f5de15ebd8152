"""Filling containers of fixed capacity: shortest-pack-first over the histogram of lengths.

The histogram has at most `capacity` entries whatever the corpus, so the packing itself is worked out on the driver:
lengths are placed longest first, each into the open pattern with most room, and patterns carry counts. Documents then
find their place by rank: the r-th document of a length takes the r-th slot that the patterns hold for that length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.session import cut

#: A pattern: the lengths it holds with their multiplicities, in order of placing.
Pattern = tuple[tuple[int, int], ...]


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and how many containers follow each; every length of the histogram is placed as often as it counts.

    A length goes into the open patterns with most room first (ties: the older pattern), as many to a container as
    still leave it the emptiest open one, and opens new containers only when none has room.
    """
    open_: list[tuple[int, int, int, Pattern]] = []  # used, age, count, pattern; least used first
    age = 0
    for length in sorted((x for x in histogram if x > 0), reverse=True):
        left = histogram[length]
        while left and open_ and open_[0][0] + length <= capacity:
            used, _, count, pattern = heapq.heappop(open_)
            # Room until this pattern is no emptier than the next, at least one item.
            nearest = open_[0][0] if open_ else capacity
            most = (capacity - used) // length
            each = max(1, min(most, -(-(nearest - used) // length), left // count if left >= count else 1))
            take = min(count, left // each)
            if take < count:
                heapq.heappush(open_, (used, age := age + 1, count - take, pattern))
            left -= take * each
            if pattern and pattern[-1][0] == length:
                pattern = (*pattern[:-1], (length, pattern[-1][1] + each))
            else:
                pattern = (*pattern, (length, each))
            heapq.heappush(open_, (used + each * length, age := age + 1, take, pattern))
        # What finds no room opens containers; the next of its length then fits there best.
        each = capacity // length
        for n, count in ((each, left // each), (left % each, 1)):
            if n and count:
                heapq.heappush(open_, (n * length, age := age + 1, count, ((length, n),)))
    return [(pattern, count) for _, _, count, pattern in sorted(open_, key=lambda p: p[1])]


def slots(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """One row per pattern and length: the ranks [low, low + n) of the length and the containers they fill."""
    rows, base, seen = [], 0, {}
    for pattern, count in patterns:
        offset = 0
        for length, each in pattern:
            low = seen.get(length, 0)
            rows.append((length, low, base, each, offset))
            seen[length] = low + each * count
            offset += length * each
        base += count
    rows.sort()
    names = ("length", "low", "base", "each", "offset")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)} | {"containers": np.int64(base)}


def _place(table: dict[str, np.ndarray], stride: int):
    """Container and offset of each (length, rank) by binary search over the slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table["length"] * stride + table["low"]
        for batch in batches:
            n, rank = (np.asarray(batch.column(i)) for i in (3, 4))
            at = np.maximum(np.searchsorted(key, n * stride + rank, side="right") - 1, 0)
            held = n > 0
            if len(key):
                k = rank - table["low"][at]
                container = table["base"][at] + k // table["each"][at]
                offset = table["offset"][at] + (k % table["each"][at]) * n
            else:
                container = offset = np.zeros(len(n), dtype=np.int64)
            # An item of no length takes no room; these are spread over the containers.
            container = np.where(held, container, rank % max(int(table["containers"]), 1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(4)], pa.array(container), pa.array(np.where(held, offset, 0))],
                names=["doc_id", "piece", "start", "n_tokens", "container", "at"],
            )

    return run


def pack(sizes: DataFrame, capacity: int = 2048, id_col: str = "doc_id", size_col: str = "n", deal: int = 1_000_000) -> DataFrame:
    """doc_id, piece, start, n_tokens, container, at: each item's place.

    An item longer than `capacity` is cut into full containers and a rest; piece counts its parts from 0 and start is
    the part's first token. `at` is the place inside the container. Items of no length (0, or null) take no room and
    are spread over the containers by id. Rows without an id are left out; repeated rows are items of their own. Items of one
    length are ranked in parts of about `deal`, so that no task orders all of a frequent length.
    """
    items = sizes.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.greatest(F.coalesce(F.col(size_col), F.lit(0)), F.lit(0)).cast("long").alias("n")
    )
    last = F.greatest(F.ceil(F.col("n") / capacity).cast("int") - 1, F.lit(0))
    parts = cut(
        items.select("doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
        .select(
            "doc_id", "piece", (F.col("piece") * F.lit(capacity).cast("long")).alias("start"),
            F.least(F.col("n") - F.col("piece") * F.lit(capacity).cast("long"), F.lit(capacity).cast("long")).alias("n_tokens"),
        )
    )
    # At most capacity + 1 rows, whatever the corpus.
    sizes_of = {r["n_tokens"]: r["count"] for r in parts.groupBy("n_tokens").count().collect()}
    many = {n: -(-k // deal) for n, k in sizes_of.items() if k > deal}
    split = F.lit(1)
    if many:
        split = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in many.items() for x in kv]), F.col("n_tokens").cast("int")), split)
    parts = parts.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), split).cast("int"))
    # At most capacity + 1 rows and one more for each `deal` items.
    counts = parts.groupBy("n_tokens", "_part").count().collect()
    histogram: dict[int, int] = {}
    first: dict[tuple[int, int], int] = {}
    for r in sorted(counts, key=lambda r: (r["n_tokens"], r["_part"])):
        first[r["n_tokens"], r["_part"]] = histogram.get(r["n_tokens"], 0)
        histogram[r["n_tokens"]] = histogram.get(r["n_tokens"], 0) + r["count"]
    table = slots(shortest_pack_first(histogram, capacity))
    stride = max([1, *histogram.values()]) + 1
    spark = sizes.sparkSession
    starts = spark.createDataFrame(
        [(n, p, low) for (n, p), low in first.items()] or [(-1, -1, 0)], "n_tokens long, _part int, _low long"
    )
    ranked = (
        parts.withColumn("_k", F.row_number().over(W.partitionBy("n_tokens", "_part").orderBy("doc_id", "piece")) - 1)
        .join(starts, ["n_tokens", "_part"])
        .select("doc_id", "piece", "start", "n_tokens", (F.col("_low") + F.col("_k")).alias("rank"))
    )
    return ranked.mapInArrow(
        _place(table, stride), "doc_id long, piece int, start long, n_tokens long, container long, at long"
    )
