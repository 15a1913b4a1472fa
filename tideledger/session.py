"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the plans count on. None of them depends on the cluster's size.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when the split costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application that all executors can reach.

    The cluster names its place in ``spark.checkpoint.dir``. Where that is unset, the place is
    below the warehouse, which every executor reaches as well. The folder goes when the
    application ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    )
    folder = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"
    if folder not in _owned:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _owned.add(folder)
    return folder


_owned: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
