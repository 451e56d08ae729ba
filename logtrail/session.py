"""Session settings and the shared folder for written stages."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on. All are runtime settings, so a session made
# elsewhere can be adjusted with configure().
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keyed state functions of the streaming jobs need this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings for speed only. Small sides are broadcast by Spark's own size check
# (spark.sql.autoBroadcastJoinThreshold), never by a hint in this package.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that a window has sorted by the keys are grouped as they come, not hashed and sorted again.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "logtrail", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RESULT_SETTINGS, **SPEED_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """Shared folder for written stages: the cluster's spark.checkpoint.dir.

    Only a local session may leave it unset; the stages then lie in its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


@cache
def _application_folder(spark: SparkSession, root: str, application: str) -> str:
    """The stages of one application lie together and go when it ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{application}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{root}/{application}"


# Paths of the stages written inside the innermost stages_of_run().
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def stages_of_run(spark: SparkSession) -> Iterator[None]:
    """Stages written inside are removed at the end; what a run returns has to be read by then."""
    written: list[str] = []
    outer = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(outer)
        for path in written:
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def application_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; it goes when the application ends."""
    folder = _application_folder(spark, stage_root(spark), spark.sparkContext.applicationId)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back.

    Used where several later passes need different narrow column sets of one
    expensive result: each pass then prunes columns at the Parquet scan, and a
    lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = application_path(spark, name)
    written = _WRITTEN.get()
    if written is not None:
        written.append(path)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
