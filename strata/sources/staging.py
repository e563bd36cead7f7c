"""Intermediate results written once and read by several steps.

A written copy cuts the lineage, survives the loss of executors, and gives later joins a
known size to choose a broadcast by.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

#: Codec of the files of table rows, which come out about a third smaller than by Spark's default.
CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local session may go without it; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="strata-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, **options: object) -> DataFrame:
    """Write the rows to the shared folder, with the writer's options, and read them back."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/staged/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_rows(df: DataFrame) -> DataFrame:
    """Stage rows of a table."""
    return stage(df, compression=CODEC)


def stage_all(frames: Mapping[str, DataFrame], parallel: int = 4) -> dict[str, DataFrame]:
    """Stage independent tables, a few at the same time."""
    if frames:
        shared_folder(next(iter(frames.values())).sparkSession)
    with ThreadPoolExecutor(parallel) as pool:
        return dict(zip(frames, pool.map(stage_rows, frames.values())))
