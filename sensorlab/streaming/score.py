"""Batch scoring for sensor files that keep arriving.

The reference scores a table once; the same fitted bundle can score a folder of new
sensor files as a Structured Streaming query: each micro-batch is cleaned, gets its
engineered features and is scored row by row, then appended to a parquet table through
``foreachBatch`` (idempotent per batch id, so a restarted query does not duplicate rows).
No state is kept between batches: scoring is row-wise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlab.operators import features, quality
from sensorlab.plans import dashboard
from sensorlab.plans.models import Bundle, score
from sensorlab.schema import SENSOR_SCHEMA


def sensor_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SENSOR_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def scored_stream(stream: DataFrame, bundle: Bundle) -> DataFrame:
    """clean view → feature view → model score → risk band, all row-wise."""
    feats = features.feature_view(quality.clean(stream))
    scored = score(bundle, feats).withColumnRenamed("score", "risk_score")
    return scored.withColumn("risk_band", dashboard.risk_band("risk_score"))


def start_scoring(spark: SparkSession, bundle: Bundle, source_dir: str, out_dir: str,
                  checkpoint_location: str, fmt: str = "parquet",
                  trigger_once: bool = False) -> StreamingQuery:
    """Start the scoring query; output rows carry the micro-batch id."""
    stream = scored_stream(sensor_stream(spark, source_dir, fmt), bundle)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
