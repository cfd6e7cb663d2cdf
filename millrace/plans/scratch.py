"""Written intermediate tables for iterative operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str = "plan") -> str:
    """A new folder in that of spark.checkpoint.dir; a local session without that setting gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/millrace-checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def writer(spark: SparkSession) -> Callable[[DataFrame, str], DataFrame]:
    """Writes a table to a folder of its own and reads it again."""
    folder = shared_folder(spark)

    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return save
