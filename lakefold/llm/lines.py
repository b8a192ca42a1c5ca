"""Line dedup by a deletion-neighbourhood join.

Lines are what `\\n` separates, without surrounding white space; lines without
a word are left alone.  In the order of (doc_id, line number), a line goes when
an earlier line, kept or not, is equal to it, or, for lines of at least LEAST
characters, within one edit (a character inserted, deleted or replaced) of it.

Keys: every line of n characters emits its n deletion variants, each under the
hash of (variant, place) and of (variant), and itself under the hash of (line).
Lines that share (variant, place) differ by one replaced character; a line
equal to another's variant is one character short of it.  Equal lines are first
reduced to their earliest occurrence, so a key holds distinct lines only, at
most one for each character that can stand there, and a line is paired with the
earliest of its key alone.  Those pairs are verified on the texts: behind their
common prefix and one edit the rest must be equal, which takes n log n steps for n
characters.

Variants are emitted only for lines that can have a partner: one edit leaves
one half of a line untouched, so a line whose halves both occur in no other
distinct line (of a length that fits) has none, and only places in the half
that may differ are needed.  Both are exact.

Defined results: a null text has no lines and stays null; an empty text stays
empty; lines of any length are compared whole; equal rows count as one
document, rows of one id with different texts as documents in the order of
their texts' hashes; null ids come first; an empty table stays empty; all
columns are carried along, under their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakefold.llm.common import blocks, filter_bit, id_filter, in_filter, release, staged
from lakefold.llm.words import mix

LEAST = 16
_SPACE = " \t\n\x0b\x0c\r"
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


AT = ["doc_id", "th", "line_no"]  # an occurrence; th is the hash of the text
_AT = "struct(doc_id, th, line_no)"
PLACE, CUT, OWN = 0, 1, 2  # what a key is to a line: (variant, place); its variant; the line itself


def _lines(docs: DataFrame) -> DataFrame:
    """AT and `line` of every line with a word."""
    split = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return split.withColumn("line", F.btrim("line", F.lit(_SPACE))).filter("line <> ''")


def _hashes() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def _half_keys() -> list[Column]:
    """Keys of the first floor(L / 2) and of the other characters, for L = n (k0, k1: this line is as long
    as a partner or longer) and for L = n + 1 (k2, k3: it is the shorter one)."""
    keys = []
    for total in (F.col("n"), F.col("n") + 1):
        cut = F.floor(total / 2).cast("int")
        keys += [F.xxhash64(total, F.lit(0), F.substring("line", F.lit(1), cut)),
                 F.xxhash64(total, F.lit(1), F.substring("line", F.col("n") - (total - cut) + 1, total - cut))]
    return [k.alias(f"k{i}") for i, k in enumerate(keys)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


def variant_keys(line: str, left: bool, right: bool, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(keys, roles): of the variants with a deletion in the left or the right half and, with `whole`, of the line."""
    chars = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    n = len(chars)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(chars) * _powers(_BASE, n), out=total[1:])
    cut, size = n // 2, np.arange(n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    places = np.concatenate([np.arange(cut if left else 0), np.arange(cut, n if right else cut)])
    variant = mix((total[places] + (total[n] - total[places + 1]) * np.uint64(_INVERSE)) ^ size[max(n - 1, 0)])
    at_place = mix(variant + (places.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9))
    own = mix(total[n:] ^ size[n]) if whole else total[:0]
    parts = [at_place, np.unique(variant), own]
    return np.concatenate(parts), np.repeat(np.array([PLACE, CUT, OWN], np.int8), [len(p) for p in parts])


_VARIANTS = pa.schema([("key", pa.int64()), ("role", pa.int8()), ("doc_id", pa.int64()), ("th", pa.int64()), ("line_no", pa.int32())])


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, "line", 1 << 18):
        made = [variant_keys(*x) for x in zip(*(c.to_pylist() for c in block.columns[3:]))]
        at = pa.array(np.repeat(np.arange(len(made)), [len(k) for k, _ in made]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([k for k, _ in made]).view(np.int64)),
                                          pa.array(np.concatenate([r for _, r in made])), *(c.take(at) for c in block.columns[:3])], schema=_VARIANTS)


def _one_edit(a: str, b: str) -> str:
    """SQL condition: the texts in columns `a` and `b` are equal or one edit apart.  The common prefix is found
    by halving: a stretch of 2^i characters joins it if it is equal in both."""
    prefix = f"""aggregate(sequence(length(bin(length({a}))) - 1, 0, -1), 0, (p, i) ->
        if(p + shiftleft(1, i) <= least(length({a}), length({b}))
           AND substring({a}, p + 1, shiftleft(1, i)) = substring({b}, p + 1, shiftleft(1, i)), p + shiftleft(1, i), p))"""
    rest = f"""substring({a}, p + if(length({a}) >= length({b}), 2, 1)) = substring({b}, p + if(length({b}) >= length({a}), 2, 1))"""
    return f"if(abs(length({a}) - length({b})) <= 1, exists(array({prefix}), p -> {rest}), false)"


def _candidates(distinct: DataFrame, least: int) -> DataFrame:
    """AT of the distinct lines that share a half with another, and where they may differ: left or
    right half (as the longer line of a pair or as long), or `whole` (as the shorter one)."""
    keys = distinct.filter(f"n >= {least}").select("h1", F.posexplode(F.array("k0", "k1", "k2", "k3")).alias("i", "key"))
    shared = (keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.min("i").alias("i"))
              .filter("lo <> hi AND i < 2").select("key"))
    found = keys.join(shared, "key").groupBy("h1").agg(
        F.max(F.col("i") == 1).alias("left"), F.max(F.col("i") == 0).alias("right"), F.max(F.col("i") >= 2).alias("whole"))
    return found.join(distinct.select("h1", "first"), "h1").select("first.*", "left", "right", "whole")


def _texts_of(places: DataFrame, docs: DataFrame) -> DataFrame:
    """`places` (AT, ...) with their `line`.  A fixed-size filter of the texts' hashes spares the other texts."""
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(places, "th"))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(in_filter(bits.value, batch.column(2))).select([0, 1])

    some = (docs.select("doc_id", "text", F.xxhash64("text").alias("th")).select("doc_id", "text", filter_bit("th").alias("bit"))
            .mapInArrow(possible, "doc_id bigint, text string"))
    lines = _lines(some).withColumnsRenamed({c: f"_{c}" for c in AT}).dropDuplicates([f"_{c}" for c in AT])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in AT]
    return places.join(lines, same).drop(*[f"_{c}" for c in AT])


def _near(distinct: DataFrame, docs: DataFrame, least: int) -> DataFrame:
    """`first` of the distinct lines that an earlier line is within one edit of."""
    spark = docs.sparkSession
    wanted = staged(_candidates(distinct, least), "line-candidates")
    release(spark)
    lines = staged(_texts_of(wanted, docs).select(*AT, "line", "left", "right", "whole"), "candidate-lines")
    release(spark, wanted)
    variants = (lines.mapInArrow(_emit, "key bigint, role tinyint, doc_id bigint, th bigint, line_no int")
                .select("key", "role", F.expr(_AT).alias("at")))
    key = W.partitionBy("key")  # distinct lines that are equal but for one character
    first = [F.min(F.when(F.col("role") == r, F.col("at"))).over(key) for r in (PLACE, CUT, OWN)]
    before = F.when(F.col("role") == PLACE, first[PLACE]).when(F.col("role") == CUT, first[OWN]).otherwise(first[CUT])
    pairs = variants.withColumn("before", before).filter("before < at").select("at", "before").distinct()
    text = lines.select(F.expr(_AT).alias("at"), "line")
    both = (pairs.join(text, "at").join(text.withColumnsRenamed({"at": "before", "line": "earlier"}), "before"))
    return staged(both.filter(_one_edit("line", "earlier")).select(F.col("at").alias("first")).distinct(), "near-lines")


def repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, th, line_no, near): the occurrences that go; `near` if no earlier line is equal.  Lines of
    `least` characters or more go for an edit as well."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = _lines(docs).withColumn("n", F.length("line")).select(*AT, "n", *_hashes(), *_half_keys())
    keys = [f"k{i}" for i in range(4)]
    distinct = staged(rows.groupBy("h1", "h2").agg(
        F.min(F.struct(*AT)).alias("first"), F.max(F.struct(*AT)).alias("last"), *[F.first(c).alias(c) for c in ("n", *keys)]), "distinct-lines")
    release(spark)
    near = _near(distinct, docs, least)
    release(spark)
    bad = (distinct.select("h1", "h2", "first", (F.col("first") < F.col("last")).alias("repeats"))
           .join(near.withColumn("near", F.lit(True)), "first", "left").filter("repeats OR near"))
    marked = _lines(docs).select(F.struct(*AT).alias("at"), *_hashes()).join(bad, ["h1", "h2"])
    return marked.filter("near OR at <> first").select("at.*", (F.col("at") == F.col("first")).alias("near")).distinct()


def _with_rest(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(row, rest): each row of `docs`, and the text that is left, n_lines (with a word), n_dropped, n_near."""
    gone = (repeated_lines(docs, least).groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
            .agg(F.collect_list("line_no").alias("gone"), F.count(F.when(F.col("near"), 1)).alias("near")))  # of one document
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.col("text"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_th")), "left")
    packed = joined.withColumn("lines", F.split("text", "\n"))
    left = F.expr("array_join(transform(array_except(sequence(0, size(lines) - 1), gone), i -> get(lines, i)), '\\n')")
    n_lines = F.expr(r"size(filter(lines, l -> l rlike '[^\\x20\\x09-\\x0D]'))")
    return packed.select("row", F.struct(
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.greatest(n_lines, F.lit(0)).cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_dropped"),
        F.coalesce("near", F.lit(0)).alias("n_near")).alias("rest"))


def drop_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """`docs` with the text that is left."""
    return _with_rest(docs, least).select(*[(F.col("rest.text") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: its lines, how many go, and the text that is left, by length and digest."""
    left = _with_rest(docs.select("doc_id", "text")).select("row.doc_id", "rest.*")
    body = F.coalesce("text", F.lit(""))
    return left.select("doc_id", "n_lines", "n_dropped", "n_near", F.length(body).cast("bigint").alias("n_chars_left"),
                       F.sha2(body, 256).alias("left_sha256"))
