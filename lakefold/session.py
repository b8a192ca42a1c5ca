"""Session construction and the shared scratch location.

Scratch data (file-based sources, sinks, lineage cuts) always lives under the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that is unset
(local runs and tests) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings chosen for scale, not only for local runs: AQE re-plans joins from
# runtime sizes, splits skewed join and rebalance partitions, and coalesces
# small shuffle partitions.  Broadcasts are decided only at run time, from the
# measured size of a materialised shuffle (a proven bound), never from the
# planner's estimate of an aggregate over a large input; explicit hints on
# tables bounded by definition still apply.  After a runtime broadcast the local
# shuffle reader reads the large side as its map tasks wrote it, so a hot key is
# not left in one task.  Strict casts rely on ANSI mode.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "lakefold",
                  shuffle_partitions: int | None = 8, extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Read from the session; set a private one only where it is unset (tests,
    local runs), so that ``DataFrame.checkpoint()`` works as well.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a per-application sub-folder; keep the parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="lakefold-scratch-")
    sc.setCheckpointDir(local)
    return local


# How tables are written: documents and keys of hexadecimal digits take far less room so.
PACKED = {"compression": "zstd"}

# Spark removes the shuffle files of a query that begins while this is set as soon as the query has ended.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _lock = {}, threading.Lock()


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """For tables that are written at once: their shuffle files go when they are written, not when the
    driver happens to collect garbage, so that the next table finds their room.  Several may be written
    side by side.  Not for a DataFrame that is handed out, as it may be computed again."""
    session = str(spark._jsparkSession.sessionUUID())
    with _lock:
        n, before = _writing.get(session, (0, None))
        if n == 0:
            before = spark.conf.get(_REMOVE_SHUFFLES, None)
            spark.conf.set(_REMOVE_SHUFFLES, "true")
        _writing[session] = (n + 1, before)
    try:
        yield
    finally:
        with _lock:
            n, before = _writing.pop(session)
            if n > 1:
                _writing[session] = (n - 1, before)
            elif before is None:
                spark.conf.unset(_REMOVE_SHUFFLES)
            else:
                spark.conf.set(_REMOVE_SHUFFLES, before)


_CREATED: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the scratch location for one write."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _CREATED.append(path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, through the Hadoop file system of its path."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_mark() -> int:
    """A marker for ``drop_scratch``: folders handed out after it can be dropped."""
    return len(_CREATED)


def drop_scratch(spark: SparkSession, mark: int) -> None:
    """Delete the scratch folders handed out since ``mark`` (through the Hadoop
    file system of each path, so it works for shared cluster storage too).

    Only for callers that know every DataFrame reading them is finished, such
    as a benchmark after each measured query.
    """
    while len(_CREATED) > mark:
        drop_folder(spark, _CREATED.pop())
