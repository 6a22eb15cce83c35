"""Sources and sinks: typed CSV load, constraint quarantine, feature
loading, preview, dataset export.

The reference bulk-loads a CSV into a constrained table; here the load is a typed CSV
scan (no schema inference pass) and the table constraints become a quarantine split:
valid rows continue, rejected rows keep the list of constraints they break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlab.schema import SENSOR_SCHEMA, constraints

c = F.col
CORRUPT = "_corrupt_record"

# Column headers of the published AI4I 2020 CSV, in file order.
AI4I_HEADERS = ["UDI", "Product ID", "Type", "Air temperature [K]", "Process temperature [K]",
                "Rotational speed [rpm]", "Torque [Nm]", "Tool wear [min]", "Target", "Failure Type"]


def load_csv(spark: SparkSession, path: str, schema: T.StructType = SENSOR_SCHEMA,
             header: bool = True) -> DataFrame:
    """Header row skipped, ',' fields, one row per line, typed to ``schema``.

    Lines that do not parse keep their text in ``_corrupt_record`` (PERMISSIVE mode)
    instead of failing the load; files split across tasks like any CSV scan."""
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]
                            + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(nullable).option("header", header).option("sep", ",")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def split_valid(df: DataFrame, key: str = "udi",
                checks: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows carry ``reject_reasons`` (constraint names, in
    declaration order, comma separated).

    Row constraints are one projection.  The primary key is a set constraint: keys that
    occur more than once are found by a grouped count (partial aggregation, so a hot
    key costs one row per task) and joined back; AQE broadcasts that key set when its
    measured size is small and splits skewed partitions otherwise.  Every row of a
    repeated key is quarantined, as a PK violation rejects the batch in the database."""
    checks = checks if checks is not None else constraints()
    dup = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(c("_n") > 1)
           .select(key, F.lit(True).alias("_dup")))
    j = df.join(dup, key, "left")
    reasons = [F.when(~cond, F.lit(name)) for name, cond in checks.items()]
    reasons.append(F.when(c("_dup"), F.lit("udi_primary_key")))
    if CORRUPT in df.columns:
        reasons.insert(0, F.when(c(CORRUPT).isNotNull(), F.lit("unparsed_line")))
    j = j.withColumn("reject_reasons", F.concat_ws(",", *reasons))
    out_cols = [x for x in df.columns if x != CORRUPT]
    valid = j.where(c("reject_reasons") == "").select(*out_cols)
    rejected = j.where(c("reject_reasons") != "").select(*out_cols, "reject_reasons")
    return valid, rejected


def load_features(spark: SparkSession, source: str, fmt: str = "parquet",
                  options: dict | None = None) -> DataFrame:
    """Read the whole feature view: a parquet/orc path, a catalog table, or JDBC
    (``fmt='jdbc'`` with url / dbtable / partitionColumn=udi / bounds / numPartitions
    in ``options`` so the read is split across tasks)."""
    if fmt == "table":
        return spark.table(source)
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load() if fmt == "jdbc" else reader.load(source)


def preview_shape(df: DataFrame) -> DataFrame:
    """One row: row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def preview_head(df: DataFrame, n: int = 5, key: str = "udi") -> DataFrame:
    """First ``n`` rows by key (a top-k: each task keeps n rows)."""
    return df.orderBy(key).limit(n)


def with_headers(df: DataFrame, headers: Sequence[str] = AI4I_HEADERS) -> DataFrame:
    """Rename a sensor table to the published CSV headers (input of the name normaliser)."""
    return df.toDF(*headers)


def export_dataset(df: DataFrame, path: str, fmt: str = "csv", partitions: int | None = None) -> None:
    """Write a dashboard extract; overwrite replaces the folder as one job commit.

    Aggregated extracts are small; ``partitions`` coalesces them to few files without
    a shuffle.  Row-level extracts keep their partitioning (one file per task)."""
    out = df.coalesce(partitions) if partitions else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
