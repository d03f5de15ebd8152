"""Percentiles of very large columns from counts in signed logarithmic buckets.

A positive value falls into bucket ceil(log_g x) with g = (1 + a) / (1 - a), a negative one into the bucket of its
size with the sign kept, zero into a bucket of its own. Any value of a bucket is within the relative error `a` of its
representative. A sketch is an ordinary table (keys, sign, bucket, n): sketches of other days or partitions are merged by
adding counts, and all work is partial aggregation, so one group may hold any share of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: The relative error of a sketch, unless another is asked for.
ERROR = 0.0005


def bucket(value: Column, error: float) -> tuple[Column, Column]:
    """Sign and bucket of a value; null for null, NaN and infinite ones."""
    v = value.cast("double")
    ok = v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= F.lit(1.7976931348623157e308))
    width = math.log((1 + error) / (1 - error))
    sign = F.when(ok, F.signum(v).cast("int"))
    return sign, F.when(ok & (v != 0), F.ceil(F.log(F.abs(v)) / F.lit(width)).cast("int")).when(ok, F.lit(0))


def representative(sign: Column, index: Column, error: float) -> Column:
    """The value that stands for a bucket."""
    width = math.log((1 + error) / (1 - error))
    return sign * F.exp(index * F.lit(width)) * F.lit(1 - error)


def sketch(df: DataFrame, keys: Sequence[str], value: str, error: float = ERROR) -> DataFrame:
    """keys, sign, bucket, n: how many values of each group fall into each bucket.

    Null, NaN and infinite values are not counted. Null keys form a group of their own.
    """
    sign, index = bucket(F.col(value), error)
    return (
        df.select(*keys, sign.alias("sign"), index.alias("bucket")).where(F.col("sign").isNotNull())
        .groupBy(*keys, "sign", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One sketch from several of the same error, whose keys may overlap."""
    union = reduce(DataFrame.unionByName, [s.select(*keys, "sign", "bucket", "n") for s in sketches])
    return union.groupBy(*keys, "sign", "bucket").agg(F.sum("n").alias("n"))


def percentiles(sk: DataFrame, keys: Sequence[str], probs: Sequence[float], error: float = ERROR) -> DataFrame:
    """keys, n, and p_<percent> per probability, each within the relative error of the interpolated percentile.

    Like percentile_cont, rank (n - 1) p is interpolated between its two neighbours; where these have one sign, the
    bound holds for the result. An empty group has no row.
    """
    order = W.partitionBy(*keys).orderBy(F.col("sign"), F.col("sign") * F.col("bucket"))
    upto = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    total = F.sum("n").over(W.partitionBy(*keys))
    ranked = sk.select(
        *keys, representative(F.col("sign"), F.col("bucket"), error).alias("_v"), upto.alias("_upto"), total.alias("_n"),
        (upto - F.col("n")).alias("_from"),
    )
    aggs = []
    for p in probs:
        rank = (F.col("_n") - 1) * F.lit(float(p))
        low, high = F.floor(rank), F.ceil(rank)
        at = [F.max(F.when((F.col("_from") <= r) & (r < F.col("_upto")), F.col("_v"))) for r in (low, high)]
        frac = F.max(rank - low)
        aggs.append((at[0] + (at[1] - at[0]) * frac).alias(percent(p)))
    return ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *aggs).where("n is not null")


def percent(p: float) -> str:
    return "p_" + f"{p * 100:g}".replace(".", "_")


def once(rows: DataFrame, id_col: str) -> DataFrame:
    """One row per id; a row without an id counts by itself."""
    return rows.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(rows.where(F.col(id_col).isNull()))


def misprinted(
    prices: DataFrame, published: DataFrame, keys: Sequence[str], value: str, stated: str, id_col: str, parts: Sequence[str] = (),
    tolerance: float = 0.01, error: float = ERROR,
) -> DataFrame:
    """The groups whose stated median is more than `tolerance` off that of the positive values, each id counted once.

    Sketches are made by keys and parts (days, channels or the like) and merged over the parts. Their error is far below the
    tolerance. Groups without a stated value, or with none to compare, are left out. A row without an id counts by itself.
    """
    finer = [*keys, *[p for p in parts if p not in keys]]
    rows = once(prices.where(F.col(value) > 0).select(id_col, *finer, value), id_col)
    medians = percentiles(merge([sketch(rows, finer, value, error)], keys), keys, [0.5], error)
    off = F.abs(F.col(stated) - F.col("p_50")) > F.lit(tolerance) * F.col("p_50")
    return published.select(*keys, stated).join(medians, list(keys)).where(off).select(*keys).distinct()
