"""Session construction and the shared working folder.

Cluster jobs keep whatever the cluster configured; only settings that are
unset get a value here. Intermediate tables and streaming checkpoints go
under ``spark.checkpoint.dir`` (a shared folder on a cluster), never under a
machine-local temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Tasks that list folders: by default up to 10,000, one path each, and each
# sends a result to the driver.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 64
NO_LOCALITY = "spark.sql.sources.ignoreDataLocality"

# Settings for large runs. AQE re-plans at runtime: it coalesces small
# shuffle partitions, splits skewed join partitions and turns a sort-merge
# join into a broadcast join only when the *measured* size of one side is
# under the threshold, which is the size check for every join in the library.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    LISTING: str(LISTING_TASKS),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "sigfleet",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`SCALE_CONF` applied.

    ``shuffle_partitions`` is the initial count before AQE coalescing: on a
    cluster, about input bytes / 256 MB; locally, the core count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    One under the local temp folder is set only when the session has none
    and runs in one process; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), "sigfleet-checkpoints")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def work_path(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/sigfleet/{kind}/{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value) -> Iterator[None]:
    """A session setting that holds inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def short_listing(spark: SparkSession) -> Iterator[None]:
    """Inside the block, folders are listed by :data:`LISTING_TASKS` tasks (or
    twice the cores), which send no block locations: for folders of many small
    files, whose list goes to the driver."""
    tasks = max(LISTING_TASKS, 2 * spark.sparkContext.defaultParallelism)
    with setting(spark, LISTING, tasks), setting(spark, NO_LOCALITY, "true"):
        yield
