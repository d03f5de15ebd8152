"""Session settings the engine relies on; everything else is left to the cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, app: str = "rodaje", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    n = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in spark.checkpoint.dir; make one only on a local master that names none."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rodaje-checkpoint-")
    sc.setCheckpointDir(named)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which all executors share; for tables that a query writes and reads back."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write df once to the shared checkpoint folder and continue from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
