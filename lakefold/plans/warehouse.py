"""A stored warehouse: silver tables, and the views over them kept as SQL text.

``store_definitions`` writes functions and views beside the tables; ``open_warehouse``
defines them in any session from what is stored, so neither the modules that build the
datasets nor a build is needed to read them.

Tables that are joined by one key again and again are stored in buckets of it
(``bucketed_write``): rows of a key lie in the file of the same number in each of the
tables, so a join or a grouping by the key reads them side by side, without a shuffle.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.plans import sinks
from lakefold.session import PACKED, brief_shuffles

DEFINITIONS = "seq int, kind string, name string, needs array<string>, body string"
LAYOUT = "_layout"


@dataclass
class Warehouse:
    root: str
    audit: DataFrame | None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    views: dict[str, DataFrame] = field(default_factory=dict)
    failed: set[str] = field(default_factory=set)  # bronze tables that were not loaded or not readable


def bucketed_write(df: DataFrame, path: str, by: str, buckets: int, sort_by: Sequence[str] = (), partition_by: str | None = None,
                   most_rows: int = 1 << 22) -> DataFrame:
    """Create-or-replace of a table in ``buckets`` files of ``by`` (of each date, if it is partitioned as well).

    A key with more than ``most_rows`` rows would make one file, and one task of each
    join, as large as itself: then the rows are dealt out by ranges instead, which
    split such a key, and joins shuffle as usual.
    """
    spark = df.sparkSession
    with brief_shuffles(spark):
        largest = df.groupBy(by).count().agg(F.max("count")).first()[0] or 0
    if largest > most_rows:
        return sinks.partitioned_write(df, path, partition_by) if partition_by else sinks.clustered_write(df, path, [by, *sort_by])
    name = f"lakefold_{uuid.uuid4().hex}"

    def write(folder: str) -> None:
        dealt = df.repartition(buckets, by)
        if partition_by:  # each bucket of each date is written by one task; a large date by as many as it has buckets
            tasks = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
            dealt = df.repartition(tasks, partition_by, F.pmod(F.hash(by), F.lit(buckets)))
        writer = dealt.write.format("parquet").options(**PACKED).bucketBy(buckets, by).sortBy(by, *sort_by).option("path", folder)
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # the files stay: a table at a location of its own
        layout = {"by": by, "buckets": buckets, "sort": [by, *sort_by], "partition": partition_by, "columns": df.schema.json()}
        fs, file = sinks._fs(spark, f"{folder}/{LAYOUT}")
        out = fs.create(file, True)
        out.write(bytearray(json.dumps(layout).encode()))
        out.close()

    sinks._replace(spark, path, write)
    return open_table(spark, path).select(*df.columns)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """A table's newest version, with its buckets if it has any."""
    folder = sinks.current_version(spark, path) or path
    fs, file = sinks._fs(spark, f"{folder}/{LAYOUT}")
    if not fs.exists(file):
        return sinks.read_table(spark, path)
    from pyspark.sql.types import StructType
    layout = json.loads(_text(spark, f"{folder}/{LAYOUT}"))
    schema = StructType.fromJson(json.loads(layout["columns"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"PARTITIONED BY (`{layout['partition']}`)" if layout["partition"] else ""
    name = "lakefold_" + folder.rsplit("-", 1)[-1]
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partitioned} CLUSTERED BY (`{layout['by']}`) "
                  f"SORTED BY ({', '.join(f'`{c}`' for c in layout['sort'])}) INTO {layout['buckets']} BUCKETS LOCATION '{folder}'")
        if partitioned:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name).select(*schema.names)


def _text(spark: SparkSession, path: str) -> str:
    """A small file of the warehouse."""
    fs, file = sinks._fs(spark, path)
    stream = fs.open(file)
    try:
        return bytes(stream.readNBytes(1 << 20)).decode()
    finally:
        stream.close()


def store_definitions(spark: SparkSession, root: str, functions: Sequence[tuple[str, str]], views: Sequence[tuple[str, list[str], str]]) -> None:
    """Keep SQL functions (name, text after the name) and views (name, what they read, query) in the warehouse."""
    rows = [("function", name, [], body) for name, body in functions] + [("view", name, needs, body) for name, needs, body in views]
    sinks.refresh_table(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DEFINITIONS).coalesce(1), f"{root}/definitions")


def open_warehouse(spark: SparkSession, root: str, as_of: str | None = None) -> Warehouse:
    """The stored silver tables of a refreshed warehouse and the stored views over them, also in a
    new session.  Nothing is built; tables and views are registered for SQL."""
    fs, silver = sinks._fs(spark, f"{root}/silver")
    names = sorted(f.getPath().getName() for f in fs.listStatus(silver)) if fs.exists(silver) else []
    tables = {n: open_table(spark, f"{root}/silver/{n}") for n in names if sinks.current_version(spark, f"{root}/silver/{n}")}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    wh = Warehouse(root, None, tables)
    now = f"CAST('{as_of}' AS TIMESTAMP_NTZ)" if as_of else "CAST(current_timestamp() AS TIMESTAMP_NTZ)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION as_of() RETURNS TIMESTAMP_NTZ RETURN {now}")
    if sinks.current_version(spark, f"{root}/definitions") is None:
        return wh
    for d in sinks.read_table(spark, f"{root}/definitions", DEFINITIONS).orderBy("seq").collect():  # some twenty texts
        if d["kind"] == "function":
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {d['name']}{d['body']}")
        elif all(n in tables or n in wh.views for n in d["needs"]):
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {d['name']} AS {d['body']}")
            wh.views[d["name"]] = spark.table(d["name"])
    return wh
