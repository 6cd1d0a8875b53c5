"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (a sort-merge join whose
# side turns out small becomes a broadcast), coalesces small shuffle partitions and splits
# skewed partitions; the session time zone is pinned so date arithmetic is stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # a selective side of a shuffle join prunes the large side's scan with a bloom filter
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerline",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Spark's defaults use bloom filters only for scans of over 10 GB whose selective side is estimated below 10 MB; that estimate
#: doesn't know what a filter keeps, so a large table's one day never is.
RUNTIME_FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
}


@contextlib.contextmanager
def runtime_filters(spark: SparkSession) -> Iterator[None]:
    """Jobs started here drop rows of a large scan that a selective side (a day, a year) of its shuffled join can't match, before
    they are shuffled. The joins follow, so no row is lost or added. The session's settings are put back."""
    before = {k: spark.conf.get(k, None) for k in RUNTIME_FILTERS}
    try:
        for k, v in RUNTIME_FILTERS.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session (one machine, as in tests) that names none gets a folder of its own; elsewhere
    executors would not see a machine-local folder, so a missing setting is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
