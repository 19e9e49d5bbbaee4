"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution carries most of the physical tuning: it coalesces small
# shuffle partitions, turns a sort-merge join into a broadcast join once the
# measured side is small, and splits skewed partitions.  The forced skew join
# accepts one more shuffle rather than one overloaded task.
#
# Methods above 8000 bytes of bytecode are never compiled by the JVM.  With the
# limit at that size a wide projection falls back to split, compiled methods
# instead of running interpreted inside one large stage.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# What else a session of our own starts with.  Call-site capture on every
# column costs more than building the plans.
OWN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    app: str = "arealytics", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **OWN_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """The settings above on a session built elsewhere; sizing is left alone."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; one of our own only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError(
                    "set spark.checkpoint.dir to a folder every executor can reach"
                )
            configured = tempfile.mkdtemp(prefix="arealytics-checkpoint-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Used where a later step must see the very same rows twice (positions given
    by a sampled range partitioning) or would compute them several times.  A
    lost executor re-reads the files instead of sampling anew, column pruning
    still works, and the optimizer knows the real size from then on.  The shuffle
    files of the way there are given back at its end.
    """
    spark = df.sparkSession
    folder = f"{_stored(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(folder)


def give_back(pinned: DataFrame) -> None:
    """Delete the pinned files that ``pinned`` reads; nothing may read them later."""
    spark = pinned.sparkSession
    for name in pinned.inputFiles():
        if _stored(spark).split(":", 1)[-1] in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)


def _stored(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}"


def drop_pinned(spark: SparkSession) -> None:
    """Delete what this application has pinned; for the end of a job, when its
    results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_stored(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
