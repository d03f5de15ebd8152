"""Equi joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    spread: Sequence[str] | None = None,
    hot: int = 2000,
) -> DataFrame:
    """Inner join on `keys`; keys with more than `hot` rows on the left are split into ceil(n / hot) parts.

    The left rows of a hot key are dealt to its parts by a hash of `spread` (default: all left columns);
    the right rows of that key are repeated once per part, so every pair meets exactly once. Rows are kept
    whole: null keys match nothing, as in any equi join. The table of hot keys has at most
    left_rows / hot entries and is joined, not collected.
    """
    keys = list(keys)
    parts = (
        left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot)
        .select(*keys, F.ceil(F.col("_n") / hot).cast("int").alias("_parts"))
    )
    deal = F.pmod(F.xxhash64(*[F.col(c) for c in (spread or left.columns)]), F.coalesce("_parts", F.lit(1)))
    a = left.join(parts, keys, "left").withColumn("_part", deal.cast("int")).drop("_parts")
    b = (
        right.join(parts, keys, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
        .drop("_parts")
    )
    joined = a.join(b, [*keys, "_part"])
    return (joined.where(condition) if condition is not None else joined).drop("_part")
