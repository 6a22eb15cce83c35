"""Written intermediate tables in the shared folder, and size-checked joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.session import app_id, checkpoint_dir

# A side of a join is broadcast only when its counted rows stay below this.
BROADCAST_ROWS = 1_000_000


def shared_path(spark, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{app_id(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage with
    files that every executor can read, and keeps column pruning."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked(keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``keys`` (a written table of a few numbers a row) with a broadcast hint if it has at
    most ``limit`` rows; beyond it the planner's shuffle join is used."""
    return F.broadcast(keys) if keys.count() <= limit else keys
