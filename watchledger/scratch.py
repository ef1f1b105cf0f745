"""Intermediate tables in the folder that all executors share.

A staged table cuts the lineage: losing an executor later never recomputes
what was staged, and every reader sees the same rows.
"""

from __future__ import annotations

import itertools
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}

#: Hosts from which a folder was tried out, by application and folder.
_tried: dict[tuple[str, str], set[str]] = {}

#: Spark's switch for dropping the shuffle files of a query once it has ended.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_freeing: dict[int, tuple[int, str | None]] = {}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here drop their shuffle files at their end, not at some collection
    of the driver's garbage. Writes side by side share the session's setting.
    """
    with _lock:
        writers, before = _freeing.get(id(spark), (0, None))
        if not writers:
            before = spark.conf.get(FREE, None)
            spark.conf.set(FREE, "true")
        _freeing[id(spark)] = writers + 1, before
    try:
        yield
    finally:
        with _lock:
            writers, before = _freeing.pop(id(spark))
            if writers > 1:
                _freeing[id(spark)] = writers - 1, before
            elif before is None:
                spark.conf.unset(FREE)
            else:
                spark.conf.set(FREE, before)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        folder = folder.rstrip("/")
        if _is_local(spark, folder) and not context.master.startswith("local"):
            _try_out(spark, folder)
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that all executors can reach"
        )
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="watchledger-")
    return _local_folders[app].name


def _is_local(spark: SparkSession, folder: str) -> bool:
    """Whether a path, by its scheme or the default one, is on the machine itself."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return path.getFileSystem(conf).getUri().getScheme() == "file"


def _try_out(spark: SparkSession, folder: str) -> None:
    """Have the executors write to a path of each machine, and look for their files.

    A mount that all machines share has such a path, and so has a disk of each machine.
    On the latter a write ends well, but the tables lack what other machines wrote.
    Executors on hosts that came since the last trial make for another one.
    """
    context = spark.sparkContext
    executors = context._jsc.sc().statusTracker().getExecutorInfos()
    hosts = {executor.host() for executor in executors}
    tried = _tried.setdefault((context.applicationId, folder), set())
    if hosts <= tried:
        return
    parts = max(context.defaultParallelism, 2 * len(executors))
    with Scratch(spark, folder) as scratch:
        written = scratch.stage(spark.range(0, parts, 1, parts).toDF("part"), "trial")
        if len(written.inputFiles()) < parts:
            raise RuntimeError(f"{folder} is local to each machine of the cluster")
    tried |= hosts


class Scratch:
    """One run's staged tables. As a context manager it drops them at the end.

    With ``free`` each table's shuffle files go once it is written.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, free: bool = False):
        self.spark, self.free = spark, free
        self.root = f"{folder or shared_folder(spark)}/run-{uuid.uuid4().hex}"
        self._serial = itertools.count(1)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a reader of what was written."""
        path = self.folder(name)
        with freed_shuffles(self.spark) if self.free else nullcontext():
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, name: str) -> str:
        """A path of its own within this run."""
        return f"{self.root}/{next(self._serial):03d}-{name}"

    def within(self, name: str) -> "Scratch":
        """For the steps towards one table, which can go once it is stored."""
        steps = Scratch(self.spark, self.root, self.free)
        steps.root = self.folder(name)
        return steps

    def drop(self) -> None:
        root, files = self._root()
        files.delete(root, True)

    def drop_at_exit(self) -> "Scratch":
        """Have the driver's JVM drop the tables when it ends, also by ``stop()``.

        For results that are read after the call that made them.
        """
        root, files = self._root()
        files.mkdirs(root)
        files.deleteOnExit(root)
        return self

    def _root(self):
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.drop()
