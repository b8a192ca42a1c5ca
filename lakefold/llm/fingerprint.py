"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash (five words) below a fixed fraction of the
hash range, so it grows with its document, sketches of parts merge into the
sketch of the whole, and the containment of a short document in a very long one
can be estimated.  A document with fewer than FLOOR hashes there keeps its
FLOOR smallest instead, which is the same sketch under a higher threshold of
its own; two sketches are compared below the lower of their thresholds.

A fingerprint is `n:hex`, n being the number of distinct shingles and hex the
kept hashes in order, 16 digits each.

Defined results: a null or empty text has the fingerprint `0:`; it is like
another empty one (1) and like nothing else (0); a text of one to four words
has one shingle; equal texts have equal fingerprints, so repeated rows agree;
very long texts are used whole; an empty table gives an empty result; only the
named columns are used.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import blocks, shuffle_width
from lakefold.llm.words import Words

SHINGLE = 5
FRACTION = 1 / 8
FLOOR = 32
BUCKETS = 16  # ranges of ids per shuffle partition
RANGES = 4096  # ranges at most: their bounds are part of the plan, and a range is streamed


def threshold(fraction: float = FRACTION) -> np.uint64:
    return np.uint64(int(fraction * 2**64))


class Sketch:
    """The kept hashes, in order, and the number of distinct shingles they were taken from."""

    __slots__ = ("kept", "n")

    def __init__(self, kept: np.ndarray, n: int):
        self.kept, self.n = kept, n

    @classmethod
    def of(cls, hashes: np.ndarray, fraction: float = FRACTION, floor: int = FLOOR) -> "Sketch":
        distinct = np.unique(hashes)
        return cls(distinct[:max(floor, int(np.searchsorted(distinct, threshold(fraction))))], len(distinct))

    @classmethod
    def read(cls, fingerprint: str) -> "Sketch":
        n, _, text = fingerprint.partition(":")
        return cls(np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64), int(n))

    def __str__(self) -> str:
        return f"{self.n}:{self.kept.astype('>u8').tobytes().hex()}"

    def below(self, fraction: float = FRACTION) -> int:
        """Every distinct hash of the document below this number is kept."""
        if self.n == len(self.kept):
            return 1 << 64
        return max(int(threshold(fraction)), int(self.kept[-1]) + 1)

    def merge(self, other: "Sketch", fraction: float = FRACTION) -> "Sketch":
        """The sketch of both documents together.  The number of distinct shingles is exact while
        both sketches are complete, and else estimated from the share of the hash range they cover."""
        limit = min(self.below(fraction), other.below(fraction))
        both = np.union1d(self.kept, other.kept)
        if limit == 1 << 64:
            return Sketch.of(both, fraction)
        both = both[both < np.uint64(limit)]
        return Sketch(both, max(len(both) + 1, round(len(both) * 2**64 / limit)))

    def compare(self, other: "Sketch", fraction: float = FRACTION) -> tuple[float, float]:
        """Estimates of (Jaccard similarity, containment of this document's shingles in the other's)."""
        if not self.n or not other.n:
            return (1.0, 1.0) if self.n == other.n else (0.0, 0.0)
        limit = min(self.below(fraction), other.below(fraction))
        a, b = self.kept, other.kept
        if limit < 1 << 64:
            a, b = a[:np.searchsorted(a, np.uint64(limit))], b[:np.searchsorted(b, np.uint64(limit))]
        common = len(np.intersect1d(a, b, assume_unique=True))
        union = len(a) + len(b) - common
        return (common / union if union else 0.0), (common / len(a) if len(a) else 0.0)


def sketches(texts: pa.Array) -> list[Sketch]:
    hashes, bounds = Words(texts).shingles(SHINGLE)
    return [Sketch.of(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `fingerprint` of every row."""
    df = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([str(s) for s in sketches(block.column(1))], pa.string())],
                                             names=["key", "fingerprint"])

    kind = df.schema["key"].dataType.simpleString()
    return df.mapInArrow(run, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def _bucket(bounds: list) -> "F.Column":
    """Number of bounds up to doc_id, searched in two steps; null ids come last."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(F.lit(0))
    step = max(1, int(len(bounds) ** 0.5))
    fine, coarse = ", ".join(f"{b}L" for b in bounds), ", ".join(f"{b}L" for b in bounds[step - 1::step])
    first = f"size(filter(array({coarse}), b -> b <= doc_id))" if coarse else "0"
    return F.expr(f"CASE WHEN doc_id IS NULL THEN {len(bounds) + 1} ELSE {first} * {step} + "
                  f"size(filter(slice(array({fine}), {first} * {step} + 1, {step}), b -> b <= doc_id)) END")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, tail, doc_id, text), so dealt and sorted that each row is followed by the
    next document by doc_id (the last one by the first).

    Ids are cut into ranges by quantiles; the first row of a range is also sent, as its `tail`, to
    the range before.  One shuffle of the texts, a row more per range, no window over the table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n = min(RANGES, BUCKETS * shuffle_width(docs.sparkSession))
    bounds = sorted({int(b) for b in docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n))})
    tie = F.xxhash64("text")
    own = docs.withColumn("bucket", _bucket(bounds))
    first = own.groupBy("bucket").agg(F.min("doc_id").alias("_id"))  # a row per range
    found = sorted(tuple(r) for r in first.collect())
    to = [(found[i - 1][0], found[i][1]) for i in range(len(found))]  # (range before, first id); the first range goes to the last
    heads = F.broadcast(docs.sparkSession.createDataFrame(to, "_to int, _id bigint"))
    tails = (own.join(heads, F.col("doc_id").eqNullSafe(F.col("_id")))
             .select(F.col("_to").alias("bucket"), F.lit(True).alias("tail"), "doc_id", "text"))
    rows = own.select("bucket", F.lit(False).alias("tail"), "doc_id", "text").unionByName(tails)
    return (rows.repartition(shuffle_width(docs.sparkSession), "bucket")
            .sortWithinPartitions("bucket", "tail", F.col("doc_id").asc_nulls_last(), tie).select("bucket", "tail", "doc_id", "text"))


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points give way to the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


REPORT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, contained_edited double, contained_next double")


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None  # the last row, when its successor is in the next block
    for block in blocks(batches, "text"):
        if held is not None:
            block = pa.Table.from_batches([held, block]).combine_chunks().to_batches()[0]
        held = block.slice(block.num_rows - 1)
        buckets, tails, ids, texts = (c.to_pylist() for c in block.columns)
        texts = [t or "" for t in texts]
        at = [i for i in range(len(ids) - 1) if not tails[i]]
        if not at:
            continue
        news = [edited(texts[i], texts[i + 1]) for i in at]
        own, new = sketches(block.column(3)), sketches(pa.array(news, pa.large_string()))
        near = [own[i].compare(s) for i, s in zip(at, new)]
        following = [own[i].compare(own[i + 1]) for i in at]
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in at], pa.int64()), pa.array([len(texts[i]) for i in at], pa.int64()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in news]),
             pa.array([str(own[i]) for i in at]), pa.array([str(s) for s in new]),
             *(pa.array([x[k] for x in xs], pa.float64()) for k in (0, 1) for xs in (near, following))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                   "near_edited", "near_next", "contained_edited", "contained_next"])


def edit_report(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and their likeness to each
    other and to the next document's."""
    return with_next(docs).mapInArrow(_compare_neighbours, REPORT)
