"""Writers: partitioned and idempotent, snapshots written only when their content changed, compact JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def materialised(df: DataFrame, path: str) -> DataFrame:
    """df written as a table and read back: later steps read the files."""
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file of any kind, through the file system that the path names."""
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions that df has rows for and leave the others; rows are brought together by partition first."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def content_hash(df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """A hash of the rows as a multiset: the same whatever their order and partitions.

    Row hashes of 64 bits from two seeds are added up in decimals and counted.
    """
    cols = [F.col(c) for c in sorted(columns or df.columns)]
    parts = [F.sum(F.xxhash64(F.lit(seed), F.to_json(F.struct(*cols))).cast("decimal(38,0)")) for seed in (1, 2)]
    r = df.agg(F.count(F.lit(1)), *parts).first()
    return "-".join(str(x) for x in r)


def write_snapshot(df: DataFrame, path: str, day: str, stamp: str = "capturado") -> bool:
    """Add df as the snapshot of a day unless the newest one has the same content; returns whether it was written.

    day is 'YYYY-MM-DD'. A day's snapshot replaces an earlier one of that day.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm):
        before = spark.read.parquet(path)
        newest = before.agg(F.max(stamp)).first()[0]
        if newest is not None and content_hash(before.where(F.col(stamp) == F.lit(newest)).drop(stamp)) == content_hash(df):
            return False
    df.withColumn(stamp, F.lit(day).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(stamp).parquet(path)
    return True


def later_source_wins(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """Of the rows of each key only those of the source with greatest priority."""
    from pyspark.sql import Window as W

    top = F.max(priority).over(W.partitionBy(*keys))
    return df.withColumn("_p", top).where(F.col(priority) == F.col("_p")).drop("_p")


def _cell(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.to_json(F.struct(F.when(~F.isnan(c), F.round(c, 4)).alias("v")), {"ignoreNullFields": "false"})
    return F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})


def row_json(df: DataFrame, name: str = "fila") -> DataFrame:
    """One JSON array per row: values in column order, floats to 4 places, NaN as null, dates as ISO text."""
    cells = [F.regexp_extract(_cell(F.col(f.name), f.dataType), r"(?s)^\{\"v\":(.*)\}$", 1) for f in df.schema.fields]
    return df.select(F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]")).alias(name))


def write_json_by(df: DataFrame, path: str, slug: str) -> None:
    """One folder of JSON lines per value of a column."""
    df.repartition(slug).write.mode("overwrite").partitionBy(slug).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
