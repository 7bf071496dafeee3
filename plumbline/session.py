"""Session set-up and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import statistics
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings every job here relies on; the cluster supplies the rest."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # recording the calling line of every column expression slows plan building
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Minute buckets and timestamp casts depend on the session zone, so pin it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: Bytes of an Arrow batch: Spark's own bound is one of rows, of which ten thousand long texts take a worker's memory.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> SparkSession:
    """Batches that Spark sends to Python hold few bytes, whatever the length of a row's text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh temporary folder; a cluster session
    without it is an error, because a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="plumbline-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def free_storage(spark: SparkSession) -> int:
    """Bytes of memory that all executors together still have for kept rows; the driver's own are left out where it isn't the only one."""
    entries, free = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().iterator(), []
    while entries.hasNext():
        free.append(entries.next()._2()._2())
    return statistics.median_high(free) * max(1, len(free) - 1)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable, in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
