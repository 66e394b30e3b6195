"""Session settings and scratch locations."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    # Hot keys are split at run time, so both switches have to stay on.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose partitions all turn out this small are hashed instead of sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Streaming aggregates keep one row per group for ever: hold them off-heap, on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` override them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    given = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **given}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else one below the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


_named: ContextVar[list[str] | None] = ContextVar("scratch paths named in this scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nobody has used yet."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (named := _named.get()) is not None:
        named.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is written below the scratch paths that are named inside, once the work inside is done.

    For work that writes its result elsewhere: frames that read such a path end with the scope.
    """
    token = _named.set([])
    try:
        yield
    finally:
        named = _named.get() or []
        _named.reset(token)
        for path in named:
            delete_folder(spark, path)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside delete their shuffle files when they end.

    Otherwise these stay until the driver happens to collect its garbage, those of all steps of a long job
    side by side. Not for a frame that is run twice as the same object: its second run would repeat the first.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store it lies; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
