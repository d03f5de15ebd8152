"""Joins Spark has no operator for, as compositions that shuffle each side once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rodaje.operators.windows import forward_fill


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, take: Sequence[str], hot: int = 1_000_000
) -> DataFrame:
    """left with, per row, the columns `take` of the last right row of its keys not after left_at; null if there is none.

    Both sides are put into one sequence per key and the last right row is carried forward, one sort instead of a range join;
    a key with more than `hot` rows is spread over tasks (`forward_fill`). Of several right rows of one key and instant the greatest
    `take` counts. Null keys and instants match nothing; every left row is kept once.
    """
    packed = right.where(F.col(right_at).isNotNull()).groupBy(*keys, F.col(right_at).alias("_at")).agg(F.max(F.struct(*take)).alias("_r"))
    rows = left.select(*keys, F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"))
    marks = packed.select(*keys, "_at", F.lit(0).alias("_side"), "_r")
    both = rows.unionByName(marks, allowMissingColumns=True)
    some = F.col("_at").isNotNull()
    for k in keys:
        some = some & F.col(k).isNotNull()
    carried = forward_fill(both, keys, [F.col("_at").asc_nulls_first(), F.col("_side")], "_r", "_seen", hot).where("_side = 1")
    return carried.select(
        *[F.col("_l")[c].alias(c) for c in left.columns], *[F.when(some, F.col("_seen")[c]).alias(c) for c in take]
    )


def bracket_join(left: DataFrame, brackets: DataFrame, value: str, low: str, high: str, keys: Sequence[str] = ()) -> DataFrame:
    """left with the bracket that holds its value: low < value <= high, where a null high is open.

    Brackets are a table of rules; equal keys are hashed and the bounds tested as a residual.
    """
    inside = (F.col(value) > F.col(low)) & (F.col(high).isNull() | (F.col(value) <= F.col(high)))
    if keys:
        right = brackets.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in brackets.columns if c not in keys])
        for k in keys:
            inside = inside & (F.col(k) == F.col(f"_k_{k}"))
        return left.join(right, inside).drop(*[f"_k_{k}" for k in keys])
    return left.join(brackets, inside)


def nearest(value: Column, centres: Sequence[float], tolerance: float) -> Column:
    """The centre nearest to a value within the tolerance, the smaller of two as near; null beyond."""
    options = F.array(*[F.struct(F.abs(value - F.lit(float(c))).alias("d"), F.lit(float(c)).alias("c")) for c in centres])
    best = F.array_min(options)
    return F.when(best["d"] <= tolerance, best["c"])


def override_join(base: DataFrame, overrides: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """base with `column` replaced where an override of its keys is given and not null."""
    o = overrides.select(*keys, F.col(column).alias("_o"))
    return base.join(o, list(keys), "left").withColumn(column, F.coalesce("_o", column)).select(*base.columns)
