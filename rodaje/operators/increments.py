"""What to load anew, and loads that fail one by one."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def changed_since(resources: DataFrame, state: DataFrame, key: str, modified: str, seen: str) -> DataFrame:
    """resources with `seen`: those never taken in, or modified after they last were. A resource without a modification time counts as changed."""
    joined = resources.join(state.select(key, seen), key, "left")
    return joined.where(F.col(seen).isNull() | F.col(modified).isNull() | (F.col(modified) > F.col(seen)))


def due(resources: DataFrame, fetched: str, today: str, days: int) -> DataFrame:
    """resources with days, the age of their last fetch: those fetched at least `days` days before `today`, or never (days is null)."""
    age = F.date_diff(F.lit(today).cast("date"), F.col(fetched).cast("date"))
    return resources.withColumn("days", age).where(F.col("days").isNull() | (F.col("days") >= days))


def run_isolated(spark: SparkSession, loads: Mapping[str, Callable[[], int | None]]) -> DataFrame:
    """fuente, bien, filas, error: each load run by itself; what one raises is kept and the others go on.

    One row per load. A load returns its number of rows, or None.
    """
    told: list[tuple[str, bool, int | None, str | None]] = []
    for name, load in loads.items():
        try:
            told.append((name, True, load(), None))
        except Exception as e:  # noqa: BLE001
            told.append((name, False, None, f"{type(e).__name__}: {e}".splitlines()[0]))
    return spark.createDataFrame(told, "fuente string, bien boolean, filas long, error string")


def failed(report: DataFrame) -> None:
    """Raise at the end if any load failed, naming them all. The report has one row per load."""
    bad = [f"{r.fuente}: {r.error}" for r in report.where("not bien").collect()]
    if bad:
        raise RuntimeError("; ".join(bad))
