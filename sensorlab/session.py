"""Spark session helpers.

Library code never creates a session on its own; callers pass one in. ``get_spark`` is
for tests, scripts and the bench. ``checkpoint_dir`` reads the cluster's shared
``spark.checkpoint.dir`` and otherwise takes a folder on Hadoop's default filesystem, so
lineage cuts always land on storage every executor can read.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "sensorlab") -> SparkSession:
    master = master or os.environ.get("SENSORLAB_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("SENSORLAB_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001  (remote sessions have no local SparkContext)
        return None


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    ``spark.checkpoint.dir`` if the session has it; otherwise a folder of this application
    on Hadoop's default filesystem, which is the shared one on a cluster."""
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    if sc is None:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can read")
    fs = sc._jvm.org.apache.hadoop.fs.FileSystem.get(sc._jsc.hadoopConfiguration())
    shared = fs.makeQualified(sc._jvm.org.apache.hadoop.fs.Path(f"/tmp/sensorlab/{app_id(spark)}")).toString()
    sc.setCheckpointDir(shared)
    return shared


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application.

    Functions that run in Python workers are pickled by reference, so the workers must be
    able to import the package even where it is only on the driver's path."""
    sc = _context(spark)
    if sc is None or app_id(spark) in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="sensorlab-", suffix=".zip")  # read by the driver only
    with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(app_id(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
