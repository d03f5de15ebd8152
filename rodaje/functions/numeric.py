"""Numbers that come out the same whatever the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_round(c: Column, digits: int) -> Column:
    """Round a double by scaling, so that both engines decide near halves alike."""
    k = float(10**digits)
    return F.round(c * F.lit(k)) / F.lit(k)


def exact_sum(c: Column, scale: int = 2) -> Column:
    """Sum in decimals, whose order doesn't matter, as a double."""
    return F.sum(c.cast(f"decimal(28,{scale})")).cast("double")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def weighted_mean(value: Column, weight: Column, scale: int = 4) -> Column:
    return safe_ratio(exact_sum(value * weight, scale), exact_sum(F.when(value.isNotNull(), weight), scale))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return scaled_round(F.lit(100.0) * safe_ratio(part, whole), digits)


def piecewise(x: Column, points: Sequence[tuple[float, Column]]) -> Column:
    """Linear between the given points, flat after the last; points whose value is null are skipped. Null before the first."""
    known = F.filter(
        F.array(*[F.struct(F.lit(float(at)).alias("x"), v.cast("double").alias("y")) for at, v in points]), lambda p: p["y"].isNotNull()
    )
    before = F.filter(known, lambda p: p["x"] <= x)
    after = F.filter(known, lambda p: p["x"] > x)
    a = F.try_element_at(before, F.lit(-1))
    b = F.try_element_at(after, F.lit(1))
    slope = (b["y"] - a["y"]) / (b["x"] - a["x"])
    return F.when(b.isNull(), a["y"]).otherwise(a["y"] + slope * (x - a["x"]))


def as_int(text: Column) -> Column:
    """A whole number written as text, else null. The test first spares the cast's costly failures."""
    return F.when(text.rlike(r"^\s*[+-]?\d{1,10}\s*$"), text.try_cast("int"))
