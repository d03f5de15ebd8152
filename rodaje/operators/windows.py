"""Window compositions: tops, distinct counts, modes, chained indices, fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rodaje.session import cut


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of each group in a total order."""
    out = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", rank) if rank else out.drop("_rn")


def count_distinct_over(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """df with the number of distinct values of its group, counted beside it and joined back (null groups included)."""
    counts = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count_distinct(value).alias(name))
    return df.join(counts, _same(keys)).drop(*[f"_{k}" for k in keys])


def ordered_mode(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Each group's most frequent value, the least of several as frequent; nulls don't count."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_b"))
    return best.select(*keys, F.col("_b.v").alias(name), (-F.col("_b.n")).alias(f"{name}_n"))


def in_ranges(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """df with _part, the number of its range of the order; rows are sorted within their range. Written once, since ranges are drawn anew by each run."""
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """df with its row numbers in a total order: places within ranges of the order, plus the sizes of the ranges before."""
    placed = in_ranges(df, order)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range.
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    # The lower 33 bits count the rows of a partition.
    numbered = placed.withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    return numbered.join(before, "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_before", "_at")


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, name: str, hot: int = 1_000_000) -> DataFrame:
    """df with the last value of its key that is not null, up to each row in the order.

    If a key has more than `hot` rows, they are dealt to tasks by ranges of the order: each range is filled by itself, and what stands
    before its first value comes from the last range of the key that has one.
    """
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    if not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot).limit(1).count():
        return df.withColumn(name, F.last(value, ignorenulls=True).over(w))
    placed = in_ranges(df, [*keys, *order])
    own = W.partitionBy("_part", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = placed.withColumn("_own", F.last(value, ignorenulls=True).over(own))
    # The last value of each range and key.
    ends = placed.withColumn("_at", F.monotonically_increasing_id()).where(F.col(value).isNotNull()).groupBy("_part", *keys).agg(F.max_by(value, "_at").alias("_last"))
    # Of all ranges and keys, those without a value included.
    parts = placed.select("_part", *keys, F.lit(None).cast(placed.schema[value].dataType).alias("_last")).distinct().unionByName(ends).groupBy("_part", *keys).agg(F.max_by("_last", F.col("_last").isNotNull()).alias("_last"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select(*[F.col(c).alias(f"_{c}") for c in ("_part", *keys)], F.last("_last", ignorenulls=True).over(before).alias("_in"))
    return filled.join(carried, _same(["_part", *keys])).withColumn(name, F.coalesce("_own", "_in")).select(*df.columns, name)


def chained_index(df: DataFrame, keys: Sequence[str], step: str, jump: str, support: str) -> DataFrame:
    """df with indice, completo, respaldo: the running product of positive jumps, whether no step before is missing,
    and the least support so far."""
    w = W.partitionBy(*keys).orderBy(step).rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.min(step).over(W.partitionBy(*keys))
    return df.where(F.col(jump) > 0).select(
        "*", F.exp(F.sum(F.log(jump)).over(w)).alias("indice"),
        (F.count(F.lit(1)).over(w) == F.col(step) - first + 1).alias("completo"), F.min(support).over(w).alias("respaldo"),
    )


def _same(keys: Sequence[str], left: str = "", right: str = "_") -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}"))
    return cond


#: Relative width of the buckets that ranks are looked up in, and what keeps their numbers positive.
_WIDTH, _SHIFT = 0.001, 1_000_000


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """keys, n, and a column per name in probs: the interpolated percentiles of each group, exact however large it is.

    Values are counted in narrow buckets, which keep their order. A rank's bucket is found by adding up these counts, and only the
    buckets that hold a rank asked for are looked into. So no task holds a group: of one that has all rows, a task sees what falls
    into a thousandth of the value's size, equal values counted. Null, NaN and infinite values don't count; null keys form a group.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= F.lit(1.7976931348623157e308))).select(
        *[F.col(k).alias(f"_{k}") for k in keys], v.alias("_v"),
        F.when(v == 0, 0.0).otherwise(F.signum(v) * (F.ceil(F.log(F.abs(v)) / F.lit(_WIDTH)) + _SHIFT)).cast("long").alias("_b"),
    )
    own = [f"_{k}" for k in keys]
    place = W.partitionBy(*own).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = rows.groupBy(*own, "_b").agg(F.count(F.lit(1)).alias("_c")).select(
        *own, "_b", "_c", (F.sum("_c").over(place) - F.col("_c")).alias("_from"), F.sum("_c").over(W.partitionBy(*own)).alias("_n")
    )
    ranks = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    holds = lambda r: (F.col("_from") <= r) & (r < F.col("_from") + F.col("_c"))
    asked = F.lit(False)
    for r in ranks.values():
        asked = asked | holds(F.floor(r)) | holds(F.ceil(r))
    wanted = counts.where(asked).select(*[F.col(k).alias(f"_{k}") for k in own], F.col("_b").alias("__b"), "_from", "_n")
    met = rows.join(wanted, _same([*own, "_b"])).groupBy(*own, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"), F.max("_from").alias("_from"), F.max("_n").alias("_n"))
    inside = W.partitionBy(*own, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    met = met.withColumn("_from", F.col("_from") + F.sum("_c").over(inside) - F.col("_c"))
    out = []
    for name, r in ranks.items():
        low, high = (F.max(F.when(holds(at), F.col("_v"))) for at in (F.floor(r), F.ceil(r)))
        part = F.max(r - F.floor(r))
        out.append(F.when(part == 0, low).otherwise(low * (1 - part) + high * part).alias(name))
    found = met.groupBy(*own).agg(F.max("_n").alias("n"), *out)
    return found.select(*[F.col(f"_{k}").alias(k) for k in keys], "n", *probs)


def trimmed_by_median(df: DataFrame, keys: Sequence[str], value: str, low: float = 0.5, high: float = 2.0) -> DataFrame:
    """The rows whose value lies within low..high times their group's median."""
    medians = exact_percentiles(df, keys, value, {"_med": 0.5}).select(*[F.col(k).alias(f"_{k}") for k in keys], "_med")
    return df.join(medians, _same(keys)).where(F.col(value).between(F.col("_med") * low, F.col("_med") * high)).select(*df.columns)


def fallback(levels: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """The first value that is not null, and the label of its level (null if all are)."""
    value = F.coalesce(*[v for _, v in levels])
    label = F.coalesce(*[F.when(v.isNotNull(), F.lit(name)) for name, v in levels])
    return value, label
