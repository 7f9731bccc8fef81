"""Stage storage: written tables that cut lineage and survive lost executors."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster the setting must be there, since a local path is not shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return root.rstrip("/")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="stage-")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the stage folder."""
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Later plans start from files with known sizes, so Spark can choose join
    strategies from real statistics and nothing upstream is computed twice.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
