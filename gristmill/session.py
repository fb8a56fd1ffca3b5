"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is what sizes shuffle partitions, picks broadcast joins from measured
# sizes and splits skewed join partitions, so the library never hints any of these.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Frees a query's shuffle files when it ends, instead of whenever the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
# By session: how many writes run with it on, and its value before the first of them.
_freeing: dict[SparkSession, tuple[int, str | None]] = {}


def build_session(app_name: str = "gristmill", **settings: str) -> SparkSession:
    """A session with the library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else the context's checkpoint folder.

    A local session without either (a laptop, a test) gets a folder of its own, which is written back
    to the session so that it is chosen once. Elsewhere a folder of one machine would lose data, so
    the library refuses to run.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="gristmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files are freed inside; writes of several threads may overlap, the last one restores the setting."""
    with _lock:
        running, before = _freeing.get(spark, (0, None))
        if not running:
            before = spark.conf.get(FREE_SHUFFLES, None)
            spark.conf.set(FREE_SHUFFLES, "true")
        _freeing[spark] = (running + 1, before)
    try:
        yield
    finally:
        with _lock:
            running, before = _freeing.pop(spark)
            if running > 1:
                _freeing[spark] = (running - 1, before)
            elif before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)


class Scope:
    """Owner of staged tables: ``close()`` deletes all it holds. Scopes are independent of each other."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: list[str] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once to the shared folder and return a scan of it.

        Used where a result feeds several later jobs. Unlike a cached or locally checkpointed frame the
        written table survives the loss of any executor, and unlike a checkpointed RDD the scan has real
        statistics, column pruning and filter pushdown. Shuffle files of the write are freed at once.
        """
        path = f"{staging_root(self.spark)}/gristmill/{name}-{uuid.uuid4().hex}"
        self._paths.append(path)
        with freeing_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        while self._paths:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(self._paths.pop())
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


# The innermost open scope of the running thread or task, and the one around it; other threads do not
# see them.
_scopes: ContextVar[tuple[Scope, ...]] = ContextVar("scopes", default=())


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``Scope.stage`` in the open ``scratch``.

    With ``keep`` the table belongs to the scope around it. Without any scope nobody owns it, and it
    stays until the folder is emptied.
    """
    scopes = _scopes.get()[: -1 if keep else None]
    return (scopes[-1] if scopes else Scope(df.sparkSession)).stage(df, name)


@contextmanager
def owned_by(scope: Scope) -> Iterator[None]:
    """Tables staged inside belong to ``scope``, which stays open."""
    token = _scopes.set((*_scopes.get(), scope))
    try:
        yield
    finally:
        _scopes.reset(token)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop the tables staged inside once the results that are kept no longer need them."""
    with Scope(spark) as scope, owned_by(scope):
        yield
