"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI stays on (the operators use try_* forms),
# UTC session time, adaptive execution with skew-join splitting.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Joins on the purchase key (InvoiceNo, InvoiceDate, CustomerID, Country)
    # reuse a partitioning on its leading, high-cardinality InvoiceNo instead
    # of re-shuffling both sides on all four columns.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A purchase (or customer) holding a large share of all lines is split
    # across tasks at the join even when that costs a shuffle before the
    # purchase aggregation: each split pre-aggregates (partial collect_set /
    # sums) before that shuffle, so no task receives the whole hot group.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # When every post-shuffle partition of a join is under this size (a
    # run-time check), AQE builds per-partition hash maps instead of sorting
    # both sides; larger or skewed partitions keep the sort-merge join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Per-purchase item sets (collect_set) stay in the object hash aggregate
    # for up to 1,024 purchases at a time (128 by default): at about 64 bytes
    # an item, 64 MB of buffers even for purchases of a thousand items.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillroll") -> SparkSession:
    """A local session for tests and the bench (Spark UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # FPGrowth shuffles and RDD checkpoints serialise JVM objects.
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Apply the job settings to an existing session (runtime SQL confs only).

    For a session of one's own; the operators do not need it (see
    :func:`splitting_skew`).
    """
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


# Needed where a hot purchase must be split at a join below its aggregate.
_SPLIT_SKEW = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
               "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
_splitting: dict[int, tuple[int, dict[str, str | None]]] = {}
_lock = threading.Lock()


@contextmanager
def splitting_skew(spark: SparkSession):
    """Jobs run inside split skewed joins even below an aggregate, whatever the session says.

    The caller's settings come back when the last of the threads inside leaves.
    """
    with _lock:
        inside, before = _splitting.get(id(spark), (0, {}))
        if not inside:
            before = {k: spark.conf.get(k, None) for k in _SPLIT_SKEW}
            for k, v in _SPLIT_SKEW.items():
                spark.conf.set(k, v)
        _splitting[id(spark)] = (inside + 1, before)
    try:
        yield
    finally:
        with _lock:
            inside, before = _splitting.pop(id(spark))
            if inside > 1:
                _splitting[id(spark)] = (inside - 1, before)
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system);
    it is read from the session.  Only when it is unset -- local tests -- a
    fresh folder under /tmp is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint root for written intermediates."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's written intermediates below the checkpoint root."""
    return os.path.join(checkpoint_root(spark), "tillroll-scratch", spark.sparkContext.applicationId)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediates, by the file system that holds them.

    For the caller to run when results that read them are stored or no longer needed.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
