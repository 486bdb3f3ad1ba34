"""Reading the tables of a data directory, and the few facts about a plan that operators need."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def current_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the latest by ``order`` (ties broken by the whole row, so that the choice is stable).

    Rows with a NULL key are dropped; a NULL in ``order`` counts as earliest; repeated rows give one row."""
    rest = [c for c, t in df.dtypes if c not in keys and c not in order and "map" not in t]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *rest]])
    return df.dropna(subset=keys).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def size_in_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a plan's size; for a scan, the size of its files (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(df: DataFrame, bytes_each: int = 32 << 20, least: int = 8) -> int:
    """How many groups to hash rows into so that one group holds about ``bytes_each`` of the plan's input."""
    return max(least, -(-size_in_bytes(df) // bytes_each))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; a cluster has no such folder, as its machines don't
    share one, so that is an error.  ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes old ones."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "vellum-checkpoints"))
    return df.checkpoint(eager=True)
