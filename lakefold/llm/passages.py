"""Texts without the passages that an earlier text has as well, from the spans of the sparse suffix array.

Texts are ordered by (doc_id, hash of the text), null ids last; equal rows count
as one text, and texts of the same words are copies.  Of copies the first keeps
its words and the others lose all of them.  Of the rest, a stretch of LEAST words
that an earlier text holds as well goes, with the white space behind each of its words.
Only stretches inside the spans that `suffixes.repeated_passages` finds can be shared, so
one row for each of those is all that is grouped; of a group only its first text is kept.

Defined results: null and empty texts and texts under LEAST words stay as they
are; repetitions inside one text stay; very long texts are used whole; an empty
table stays empty; all columns are carried along, under their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import blocks, id_filter, passing, release, staged
from lakefold.llm.suffixes import LEAST, _merge, repeated_passages
from lakefold.llm.words import Words, run_hashes

ORDER = ["unnamed", "doc_id", "xh"]  # of a text; xh is its hash


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, spans, class, ORDER) to (stretch, start, end, class, ORDER): every stretch of LEAST words inside the
    spans, by its hash, with its characters up to the word behind it."""
    for block in blocks(batches, "text"):
        words = Words(block.column(0))
        raw = np.frombuffer("".join(block.column(0).to_pylist()).encode(), np.uint8)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters before each byte
        rows, keys, starts, ends = [], [], [], []
        for i, spans in enumerate(block.column(1).to_pylist()):
            first, last, base = words.first[i], words.first[i + 1], chars[words.offsets[i]]
            begins = np.append(chars[words.start[first:last]], chars[words.offsets[i + 1]]) - base
            for a, b in (map(int, span.split(":")) for span in spans.split(",")):
                at = np.arange(a, b - LEAST + 1)
                rows.append(np.full(len(at), i))
                keys.append(run_hashes(words.hash[first:last], at, at + LEAST))
                starts.append(begins[at])
                ends.append(begins[at + LEAST])
        own = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), *(pa.array(np.concatenate(c).astype(np.int32)) for c in (starts, ends)),
             *(block.column(k).take(own) for k in range(2, 6))], names=["stretch", "start", "end", "class", *ORDER])


def later_passages(docs: DataFrame) -> DataFrame:
    """Per (doc_id, xh) of a text that has a passage in common with an earlier one: `whole` if all its words go,
    else `gone`, the ranges of characters that go (start:end, end exclusive, comma-joined)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("xh"))
    found = staged(repeated_passages(rows.select(F.col("xh").alias("doc_id"), "text"))
                   .select(F.col("doc_id").alias("xh"), "spans", F.coalesce("first_copy", "doc_id").alias("class")).distinct(), "passages")
    release(spark)
    owners = staged(rows.select("doc_id", "xh").distinct().join(found, "xh")
                    .withColumns({"unnamed": F.col("doc_id").isNull(), "at": F.xxhash64("doc_id", "xh")}), "passage-owners")
    heads = (owners.groupBy("class").agg(F.min(F.struct(*ORDER)).alias("head"), F.first("spans").alias("spans"))
             .select("class", "head.*", "spans").withColumn("at", F.xxhash64("doc_id", "xh")))
    heads = staged(heads, "passage-heads")
    release(spark, found)
    bits = spark.sparkContext.broadcast(id_filter(heads, "at", hashed=True))
    texts = (passing(rows.select("text", F.xxhash64("doc_id", "xh").alias("at")), "at", bits)
             .groupBy("at").agg(F.first("text").alias("text")).join(heads, "at").select("text", "spans", "class", *ORDER))
    stretches = staged(texts.mapInArrow(_stretches, "stretch bigint, start int, end int, class bigint, unnamed boolean, doc_id bigint, xh bigint"),
                       "passage-stretches")
    release(spark)
    of = F.struct(*ORDER)
    shared = (stretches.groupBy("stretch").agg(F.min(of).alias("first"), F.max(of).alias("last"))
              .filter("first < last").select("stretch", "first"))
    gone = (stretches.join(shared, "stretch").filter(of > F.col("first")).groupBy(F.col("class").alias("th"))
            .agg(F.collect_list(F.struct("start", "end")).alias("pairs"))  # of one text
            .mapInArrow(_merge, "th bigint, n_gone bigint, gone string").select(F.col("th").alias("class"), "gone"))
    first = heads.select("class", F.col("at").alias("head"))
    return (owners.select("doc_id", "xh", "at", "class").join(first, "class").join(gone, "class", "left")
            .select("doc_id", "xh", (F.col("at") != F.col("head")).alias("whole"), "gone").filter("whole OR gone IS NOT NULL"))


def drop_later_passages(docs: DataFrame) -> DataFrame:
    """`docs` with the text that is left."""
    later = staged(later_passages(docs), "later-passages").select(F.xxhash64("doc_id", "xh").alias("at"), "whole", "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"),
                       F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("at"))
    bounds = F.expr("transform(split(gone, '[:,]'), x -> int(x))")  # start, end, start, ...
    left = F.expr("""array_join(transform(sequence(0, size(cuts) div 2), i -> substring(text, if(i = 0, 0, cuts[2 * i - 1]) + 1,
                     if(2 * i < size(cuts), cuts[2 * i], length(text)) - if(i = 0, 0, cuts[2 * i - 1]))), '')""")
    text = F.when(F.col("whole"), "").when(F.col("gone").isNull(), F.col("text")).otherwise(left)
    joined = rows.join(later, "at", "left").withColumn("cuts", bounds).select("row", text.alias("left"))
    return joined.select(*[(F.col("left") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
