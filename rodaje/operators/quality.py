"""Data tests: each gives the rows, or the counts, that violate an expectation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_unique(df: DataFrame, keys: Sequence[str], where: str = "true") -> DataFrame:
    """Key combinations that occur more than once."""
    return df.where(where).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def nulls(df: DataFrame, column: str, where: str = "true") -> DataFrame:
    return df.where(where).where(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is given but not listed."""
    return df.where(~F.col(column).isin(*values))


def out_of_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None, inclusive: bool = True) -> DataFrame:
    c, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (c < low if inclusive else c <= low)
    if high is not None:
        bad = bad | (c > high if inclusive else c >= high)
    return df.where(bad)


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value is given but not in the parent."""
    keys = parent.select(F.col(parent_column).alias("_k")).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_k"), "left_anti")


def not_continuous(scale: DataFrame, keys: Sequence[str], low: str, high: str, fixed: str, pct: str, tolerance: float = 0.01) -> DataFrame:
    """Brackets that do not start where the one below ends, or whose fixed amount is not what the one below comes to."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*keys).orderBy(low)
    prior = {c: F.lag(c).over(w) for c in (low, high, fixed, pct)}
    rows = scale.select("*", *[v.alias(f"_{c}") for c, v in prior.items()])
    expected = F.col(f"_{fixed}") + (F.col(f"_{high}") - F.col(f"_{low}")) * F.col(f"_{pct}") / 100
    bad = F.col(f"_{low}").isNotNull() & ((F.col(low) != F.coalesce(f"_{high}", F.lit(-1.0))) | (F.abs(F.col(fixed) - expected) > tolerance))
    return rows.where(bad).select(*scale.columns)


def violations(checks: Mapping[str, DataFrame]) -> DataFrame:
    """prueba, fallas: how many rows each check gives."""
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("fallas")).select(F.lit(name).alias("prueba"), "fallas")
    return reduce(DataFrame.unionByName, [one(n, df) for n, df in checks.items()])


def profile(df: DataFrame) -> DataFrame:
    """columna, filas, nulos, distintos, menor, mayor, mas_largo: one row per column, from one pass; values are compared as their columns' types and shown as text.

    Distinct values are counted exactly. An empty table has counts of 0 and no least value.
    """
    aggs = []
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        text = lambda x: x.cast("string")
        aggs.append(F.struct(
            F.lit(c).alias("columna"), F.count(F.lit(1)).alias("filas"), F.count_if(col.isNull()).alias("nulos"), F.count_distinct(col).alias("distintos"),
            text(F.min(col)).alias("menor"), text(F.max(col)).alias("mayor"), F.max(F.length(text(col))).cast("long").alias("mas_largo"),
        ).alias(f"c{i}"))
    return df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def graded(checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """prueba, valor, estado: each check is a row of v, error and warn; estado is 'error', 'aviso' or 'bien'. A check without a value is an error."""
    state = F.when(F.coalesce(F.col("error"), F.lit(True)), "error").when(F.coalesce(F.col("warn"), F.lit(True)), "aviso").otherwise("bien")
    one = lambda name, df: df.select(F.lit(name).alias("prueba"), F.col("v").cast("double").alias("valor"), state.alias("estado"))
    return reduce(DataFrame.unionByName, [one(n, df) for n, df in checks])


def conserved(before: DataFrame, after: DataFrame, amount: Column | None = None) -> bool:
    """Whether a step kept its rows, or the sum of an amount; for use after left joins."""
    total = F.count(F.lit(1)) if amount is None else F.sum(amount.cast("decimal(38,4)"))
    return before.agg(total).first()[0] == after.agg(total).first()[0]


def validate(df: DataFrame, least_rows: int = 1, most_null: Mapping[str, float] | None = None, ranges: Mapping[str, tuple[float, float]] | None = None, keys: Sequence[str] = ()) -> list[str]:
    """What is wrong with a delivery, in words; one pass for all but the keys. Empty if it may be taken in."""
    most_null, ranges = dict(most_null or {}), dict(ranges or {})
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in most_null]
    aggs += [F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"range {c}") for c, (lo, hi) in ranges.items()]
    r = df.agg(*aggs).first()
    out = [f"{r['n']} rows, expected {least_rows}"] if r["n"] < least_rows else []
    out += [f"{c}: {r[f'null {c}']} null" for c, share in most_null.items() if r[f"null {c}"] > share * r["n"]]
    out += [f"{c}: {r[f'range {c}']} out of range" for c in ranges if r[f"range {c}"]]
    if keys and not not_unique(df, keys).isEmpty():
        out.append(f"{', '.join(keys)}: not unique")
    return out
