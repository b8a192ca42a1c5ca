"""Shared helpers of the operators: table access, lineage cuts, global order, memory-bounded batches."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakefold.session import fresh_path

#: Bytes of text that a Python helper works on at a time; the arrays it makes are a small multiple.
BLOCK_BYTES = 1 << 19

#: Bits of a broadcast id filter (4 MB), whatever the number of ids.
FILTER_BITS = 1 << 25

WORD_SPLIT = r"[\x20\x09-\x0D]+"  # what separates words everywhere in this package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: a lineage cut
    that survives lost executors and lets several consumers share one pass."""
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, *cols: str) -> DataFrame:
    """Add `pos`, the 0-based global row number in the order of `cols` (nulls last).

    Rows are dealt out by range, numbered inside their range, and each range is
    shifted by the sizes of those before it (one row per range).  No window
    spans the table.  `df` should hold little more than its order columns.
    """
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_last() for c in cols]
    dealt = staged(df.repartitionByRange(shuffle_width(spark), *order)
                   .withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    shift = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    return (dealt.withColumn("_own", own).join(F.broadcast(shift), "_range")  # bounded by the number of ranges
            .withColumn("pos", F.col("_shift") + F.col("_own")).drop("_range", "_own", "_shift"))


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that `column` holds about `limit` bytes in each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = col.buffers()[1]
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        off = np.frombuffer(ends, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(off, int(off[at]) + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
        del batch, col, ends, off
    pa.default_memory_pool().release_unused()  # the worker may wait long for its next task


def release(spark: SparkSession, *done: DataFrame) -> None:
    """Free what finished steps left: the folders of `done` (from `staged`), and the shuffle files of
    plans nobody holds any more, which Spark deletes once the driver has collected them as garbage."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for df in done:
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(conf).delete(folder, True)
    gc.collect()
    jvm.System.gc()


def filter_bit(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def id_filter(ids: DataFrame, column: str, hashed: bool = False, size: int = FILTER_BITS) -> np.ndarray:
    """A bit set with the bits of all ids (with `hashed`, ids are hashes and their low bits serve).  It spares a shuffle of rows that have no
    partner; what it lets through wrongly has to be removed by a join afterwards."""
    bit = F.col(column).bitwiseAND(F.lit(size - 1)) if hashed else filter_bit(column)
    words = ids.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit % 64 AS INT)))").alias("bits"))
    out = np.zeros(size // 64, np.int64)
    got = words.toArrow()  # at most size / 64 rows
    out[got["w"].to_numpy()] = got["bits"].to_numpy()
    return out


def in_filter(bits: np.ndarray, numbers: pa.Array) -> pa.Array:
    at = numbers.to_numpy()
    return pa.array((bits[at >> 6] >> (at & 63)) & 1 == 1)


def passing(df: DataFrame, column: str, bits) -> DataFrame:
    """Rows of `df` whose hash in `column` is in a broadcast filter."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(at).to_numpy() & np.int64(FILTER_BITS - 1)
            yield batch.filter(in_filter(bits.value, pa.array(numbers)))

    return df.mapInArrow(run, df.schema)
