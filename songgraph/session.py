"""Spark session and checkpoint-directory helpers.

Cluster jobs get their settings from spark-submit; this module only fills in
what a local run (tests, bench) needs and never overrides a value that is
already set on the session.
"""

from __future__ import annotations

import gc
import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants. AQE re-plans joins at runtime (broadcast only when
# the measured side is under the threshold), coalesces small shuffle outputs
# and splits skewed join partitions.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "songgraph",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster this must be a shared folder named by ``spark.checkpoint.dir``;
    only a local-mode session (tests, bench) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) that every executor can read")
    scratch = tempfile.mkdtemp(prefix="songgraph-ckpt-",
                               dir=os.environ.get("SONGGRAPH_SCRATCH", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


# the scopes open in each thread, innermost last (streaming batches run in threads of their own)
_OPEN = threading.local()


class Scratch:
    """The written tables of one piece of work. They go when the scope ends, sooner
    with ``free``; what ``keep`` writes goes to the enclosing scope instead, so it
    outlives the tables it was made from. Tables written outside any scope are the
    caller's."""

    def __init__(self, spark: SparkSession, parent: "Scratch | None"):
        self.spark, self.parent, self.paths = spark, parent, []

    def keep(self, df, name: str = "kept"):
        """Write ``df`` for the caller of this piece of work; a table of this scope is
        handed over as it is."""
        homes = _homes(df)
        if not homes or any(p not in self.paths for p in homes):
            return _write(df, name, self.parent)
        for path in homes:
            self.paths.remove(path)
            if self.parent is not None:
                self.parent.paths.append(path)
        return df

    def folder(self, name: str) -> str:
        """A new folder that goes with this scope."""
        self.paths.append(new_folder(self.spark, name))
        return self.paths[-1]

    def free(self, *tables) -> None:
        """Delete tables of this scope whose last reader has run."""
        for path in {p for t in tables for p in _homes(t) if p in self.paths}:
            self.paths.remove(path)
            _delete(self.spark, path)

    def sweep(self) -> None:
        """Have the driver collect the frames that are gone, upon which Spark removes their
        shuffle files from the executors' disks. For work of many large shuffles: left to
        itself, the driver collects when its own memory is short."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def close(self) -> None:
        """Delete what is left."""
        while self.paths:
            _delete(self.spark, self.paths.pop())


@contextmanager
def scratch(spark: SparkSession):
    """Own every table that ``materialize`` writes inside the block and delete it at
    the end, also after a failure. A lazy frame over such a table must be written
    (``keep``, a sink) before the block ends."""
    scopes = _OPEN.__dict__.setdefault("scopes", [])
    scope = Scratch(spark, scopes[-1] if scopes else None)
    scopes.append(scope)
    try:
        yield scope
    finally:
        scopes.remove(scope)
        scope.close()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop path and its file system (the driver's view of any store)."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    where, fs = file_system(spark, path)
    fs.delete(where, True)


def _homes(table) -> list[str]:
    """Where ``materialize`` wrote ``table``."""
    return getattr(table, "_written_to", [])


def _write(df, name: str, owner: Scratch | None):
    spark = df.sparkSession
    path = new_folder(spark, name)
    if owner is not None:
        owner.paths.append(path)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._written_to = [path]
    return out


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the checkpoint folder and read it back:
    the result is computed once, its lineage is cut, and every later use reads
    files from the shared folder (no recomputation after an executor loss).
    Inside a ``scratch`` block the table belongs to it."""
    scopes = getattr(_OPEN, "scopes", None)
    return _write(df, name, scopes[-1] if scopes else None)
