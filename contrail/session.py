"""Session and scratch-space helpers.

Library code never builds its own session: every function takes the caller's
``SparkSession``. ``build_session`` is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run of the library relies on. AQE stays on so shuffle
# partition counts, join strategies and skewed partitions are re-planned
# from runtime sizes instead of being hand-tuned per query.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "contrail",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is left alone. Only
    when it is unset and the session is local (tests) do we pick a private folder
    under /tmp; any other master must name a shared one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="contrail-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder.

    Written tables that must survive executor loss (marts, landed feeds,
    stream sinks and their checkpoints) go here, never to a machine-local
    temporary folder.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/contrail-scratch/{name}-{uuid.uuid4().hex[:12]}"


# Spark's own switch: an action's shuffle files are removed when it ends, not when the driver's garbage collector finds them.
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each action inside go when it ends, so a job of several writes holds those of one at a time.

    A frame that is read again later makes them again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
