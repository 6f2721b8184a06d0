"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that only matter for results (time zone) or for skewed joins. All can be set at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    # Split a skewed join even where the split costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "strata", cores: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own session; see :func:`tune`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: With it, the shuffle files of a query are deleted when the query ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that are built and run inside leave no shuffle files behind, so the disk holds those of one query at a time."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def shuffled(df: DataFrame) -> bool:
    """Do the rows of ``df`` come out of a shuffle by keys (a join, an aggregate), rather than from files?"""
    return "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it in ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, where every executor runs on the same machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="strata-")
    return folder


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later passes do not recompute it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
