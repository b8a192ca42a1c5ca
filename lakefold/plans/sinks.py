"""Sinks and layout: bronze landing, table refresh, date partitioning,
clustering, and the load audit trail.

A table is a folder of versions.  A write makes a new version folder beside the others
and, once that is complete, a marker file that names it; the newest marker is the
table.  Creating that one small file is the whole switch: readers see the old version
or the new one at any moment, on file systems and on object stores alike (nothing is
renamed).  A run that fails leaves no marker, so the old version stays.  The last
``KEEP`` versions remain, so a reader that began on the one before can finish.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakefold.fixed import AUDIT_MESSAGES
from lakefold.session import PACKED, brief_shuffles, drop_folder
from lakefold.sources.files import CORRUPT, accepted, rejected


def land_bronze(df: DataFrame, schema: StructType, path: str) -> DataFrame:
    """Write ``df`` as a typed bronze table (full refresh) and return the table.

    Columns are selected and cast to the declared schema, so a source that
    drifts fails here instead of in a downstream view.
    """
    return refresh_table(conform(df, schema), path)


def conform(df: DataFrame, schema: StructType | str) -> DataFrame:
    """The declared columns, in order, cast to their declared types (ANSI: a value
    that does not fit fails the load)."""
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in st.fields])


def setup_tables(spark: SparkSession, root: str, schemas: dict[str, str]) -> None:
    """Create each table that is missing, or has other columns than declared, as an empty
    table with its declared schema (the schema-setup step run before the loads).  A table
    that is there keeps its last version until its load has succeeded."""
    for name, ddl in schemas.items():
        path, empty = f"{root}/{name}", spark.createDataFrame([], ddl)
        if current_version(spark, path) is None or read_table(spark, path).schema.simpleString() != empty.schema.simpleString():
            refresh_table(empty, path)


KEEP = 2
_MARKERS = "_versions"


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions, oldest first: a number, and something unique."""
    fs, folder = _fs(spark, f"{path}/{_MARKERS}")
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of a table's newest complete version."""
    found = _versions(spark, path)
    return f"{path}/{found[-1]}" if found else None


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A table's newest version; a plain folder of Parquet files is read as it is."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current_version(spark, path) or path)


def _replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Write a table's new version and make it the newest; returns its folder."""
    before = _versions(spark, path)
    number = int(before[-1].split("-")[0][1:]) + 1 if before else 1
    name = f"v{number:08d}-{uuid.uuid4().hex}"
    with brief_shuffles(spark):
        write(f"{path}/{name}")
    fs, marker = _fs(spark, f"{path}/{_MARKERS}/{name}")
    fs.create(marker, False).close()
    for old in _versions(spark, path)[:-KEEP]:
        fs.delete(_fs(spark, f"{path}/{_MARKERS}/{old}")[1], False)  # the marker first: no reader begins on it any more
        drop_folder(spark, f"{path}/{old}")
    return f"{path}/{name}"


def refresh_table(df: DataFrame, path: str) -> DataFrame:
    """Create-or-replace: the table becomes the query result, whole or not at all."""
    made = _replace(df.sparkSession, path, lambda new: df.write.options(**PACKED).parquet(new))
    return df.sparkSession.read.schema(df.schema).parquet(made)


def _by_date(df: DataFrame, by: str, cluster_by: Sequence[str]) -> DataFrame:
    out = df.hint("rebalance", by)
    return out.sortWithinPartitions(by, *cluster_by) if cluster_by else out


def partitioned_write(df: DataFrame, path: str, by: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Create-or-replace of a table partitioned by a date column; dates that are not
    in ``df`` are gone afterwards.

    ``rebalance`` on the partition column gives each date few files, and AQE
    splits a date that holds a large share of the rows over several tasks.
    ``cluster_by`` sorts rows within each file (after the rebalance, so the
    order survives) for row-group skipping on those columns.
    """
    made = _replace(df.sparkSession, path, lambda new: _by_date(df, by, cluster_by).write.options(**PACKED).partitionBy(by).parquet(new))
    return df.sparkSession.read.schema(df.schema).parquet(made).select(*df.columns)


def replace_dates(df: DataFrame, path: str, by: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Replace only the dates that ``df`` holds, and keep the others.  This changes the newest
    version itself: dates are switched one by one, as files of the others are not copied."""
    path = current_version(df.sparkSession, path) or path
    (_by_date(df, by, cluster_by).write.options(**PACKED).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by).parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def clustered_write(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Create-or-replace of a table dealt out by ranges of ``by`` and sorted within files.

    A file then spans a narrow range of the clustering columns, so a filter on
    them opens few files and skips row groups.  A hash of the row breaks ties,
    which splits a hot key over several ranges.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*df.columns)
    made = _replace(df.sparkSession, path, lambda new: df.repartitionByRange(n, *by, tie).sortWithinPartitions(*by).write.options(**PACKED).parquet(new))
    return df.sparkSession.read.schema(df.schema).parquet(made)


# -- load audit -----------------------------------------------------------------
AUDIT_SCHEMA = ("seq int, logged_at timestamp, operation string, table_id string, status string, "
                "message string, n_rows long, n_rejected long")


@dataclass
class Loader:
    operation: str
    table_id: str
    source: str
    build: Callable[[], DataFrame]
    after: str | None = None  # the landed table it reads
    sep: str | None = None    # of a delimited source whose misfits are kept: ``build`` gives ``scan_delimited`` rows


class SetupFailed(RuntimeError):
    """The schema setup failed; no load was attempted."""


def run_loads(spark: SparkSession, loaders: Sequence[Loader], target_root: str, audit_path: str,
              audit_format: str = "parquet", max_parallel: int = 4,
              setup: tuple[str, Callable[[], None]] | None = None) -> DataFrame:
    """Run the loads; a failure is logged and the remaining loads continue.

    ``setup`` = (name, action) runs first and is audited as ``run_ddl_script``;
    if it fails, the failure is audited and ``SetupFailed`` is raised without
    running any load.

    Each load is an independent Spark write; up to ``max_parallel`` of them run
    as concurrent jobs (small sources would otherwise leave the cluster idle).
    Loads that read a landed table run after the others, and fail if that load failed.
    A load's row count is observed during the write itself (no second pass).  A
    loader with ``sep`` keeps what does not fit its declared columns in the table
    ``<table>_rejects`` (line, reason) and counts it in ``n_rejected``.
    Audit rows keep the order of ``loaders`` (START then SUCCESS/ERROR for
    each), are appended to ``audit_path`` (Parquet, or CSV with a header like
    the reference's log file) and returned.
    """
    from concurrent.futures import ThreadPoolExecutor

    def now() -> dt.datetime:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def write_audit(records: list[tuple]) -> DataFrame:
        audit = spark.createDataFrame(records, AUDIT_SCHEMA)
        if audit_format == "csv":
            (audit.select(F.date_format("logged_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
                          "operation", "table_id", "status", "message")
                  .coalesce(1).write.mode("append").option("header", True).option("escape", '"').csv(audit_path))
        else:
            audit.write.mode("append").parquet(audit_path)
        return audit

    head: list[tuple] = []
    if setup is not None:
        name, action = setup
        head.append((1, now(), "run_ddl_script", name, "START", AUDIT_MESSAGES["ddl_start"].format(name), None, None))
        try:
            action()
        except Exception as exc:  # noqa: BLE001 - audited, then the run stops
            head.append((2, now(), "run_ddl_script", name, "ERROR",
                         AUDIT_MESSAGES["ddl_failed"].format(name, str(exc).strip() or type(exc).__name__), None, None))
            write_audit(head)
            raise SetupFailed(name) from exc
        head.append((2, now(), "run_ddl_script", name, "SUCCESS", AUDIT_MESSAGES["ddl_done"].format(name), None, None))
    offset = len(head)

    def land(i: int, ld: Loader) -> tuple[int, int | None]:
        """Write the table, and count its rows on the way."""
        obs, path = Observation(f"rows_{ld.table_id}_{i}"), f"{target_root}/{ld.table_id}"
        if ld.sep is None:
            refresh_table(ld.build().observe(obs, F.count(F.lit(1)).alias("n")), path)
            return obs.get["n"], None
        misfit = F.col(CORRUPT).isNotNull()
        held = f"{path}_rows-{uuid.uuid4().hex}"  # the source is parsed once, and rows and misfits are read from here
        rows = ld.build()
        with brief_shuffles(spark):
            rows.observe(obs, F.count_if(~misfit).alias("n"), F.count_if(misfit).alias("bad")).write.options(**PACKED).parquet(held)
        kept = spark.read.schema(rows.schema).parquet(held)
        refresh_table(rejected(kept, ld.sep), f"{path}_rejects")
        refresh_table(accepted(kept), path)
        drop_folder(spark, held)
        return obs.get["n"], obs.get["bad"]

    def run_one(i: int, ld: Loader) -> list[tuple]:
        i = i + offset // 2
        start = (2 * i + 1, now(), ld.operation, ld.table_id, "START", AUDIT_MESSAGES["load_start"].format(ld.source), None, None)
        try:
            if ld.after in broken:
                raise RuntimeError(f"{ld.after} was not loaded")
            n, bad = land(i, ld)
        except Exception as exc:  # noqa: BLE001 - keep the remaining loads running
            text = str(exc).strip() or type(exc).__name__
            end = (2 * i + 2, now(), ld.operation, ld.table_id, "ERROR",
                   AUDIT_MESSAGES["load_failed"].format(ld.source, text), None, None)
        else:
            end = (2 * i + 2, now(), ld.operation, ld.table_id, "SUCCESS", AUDIT_MESSAGES["load_done"].format(ld.table_id), n, bad)
        return [start, end]

    results: dict[int, list[tuple]] = {}
    broken: set[str] = set()
    for wave in ([i for i, ld in enumerate(loaders) if not ld.after], [i for i, ld in enumerate(loaders) if ld.after]):
        with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
            results.update(zip(wave, pool.map(lambda i: run_one(i, loaders[i]), wave)))
        broken = {loaders[i].table_id for i in results if results[i][1][4] == "ERROR"}
    return write_audit(head + [r for i in range(len(loaders)) for r in results[i]])


AUDIT_CSV_SCHEMA = "timestamp string, operation string, table_id string, status string, message string"


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Read an audit CSV: quoted messages may span lines and hold doubled quotes;
    timestamps may be naive or carry an offset (both parse)."""
    raw = (spark.read.schema(AUDIT_CSV_SCHEMA).option("header", True).option("multiLine", True)
           .option("escape", '"').csv(path))
    return raw.withColumn("logged_at", F.try_to_timestamp("timestamp"))
