"""Passages that repeat across documents, by a sparse suffix array.

Texts are word sequences (`[^\\x20\\x09-\\x0D]+`).  Of all suffixes only those are
kept that start where the hash of the next GRAM words is the smallest in a
window of WINDOW starts.  The choice depends on content alone, so a passage of
LEAST words is entered at the same places wherever it occurs: every stretch of
GRAM + WINDOW - 1 = 25 words holds a kept start, hence in a passage of LEAST =
50 words the first kept start has at least ROOT = 33 words of it to its right.

1. Kept suffixes are counted by the hash of their first ROOT words; the others
   can be part of no passage.
2. Suffixes whose root occurs in two documents are sorted by range, once by
   (root, next words) and once by (root, words before, nearest first).  Each is
   compared with its neighbours there, and matches are extended right and left.
   A match of LEAST words or more is a passage.  No suffix agrees farther to the
   right than a neighbour in the first order, or to the left than one in the
   second, so where such a neighbour's match is a passage, that end is final.
3. Where it is not, another suffix farther off may still match (shorter on one
   side, longer on the other).  Unless both limits together are under LEAST
   words, that is settled by the hashes of all stretches of LEAST words around.
4. Matches of a document are merged.

Documents with the same word sequence are one text throughout, and such copies
are passages as a whole.  Suffixes at the ends of ranges go to step 3, so
nothing hangs on where ranges end; no root is gathered in one task.

Defined results: texts under LEAST words, empty and null texts have no passage;
repetitions inside one document alone are none; rows that repeat are copies of
each other, with a null id as well; very long texts are used whole; an empty
table gives an empty result; only doc_id and text are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import FILTER_BITS, blocks, id_filter, in_filter, passing, release, shuffle_width, staged
from lakefold.llm.words import Words, mix, run_hashes

LEAST = 50
GRAM = 8
WINDOW = 18
SIDE = WINDOW - 1                 # words before a kept start that can belong to a passage without an earlier kept start
ROOT = LEAST - SIDE               # 33
HASH_BITS = 1 << 27               # bits of the broadcast filters of roots and stretches (16 MB)


def kept_starts(hashes: np.ndarray) -> np.ndarray:
    """Starts of the kept suffixes of a text, given its word hashes."""
    if len(hashes) < GRAM + WINDOW - 1:
        return np.zeros(0, np.int64)
    at = np.arange(len(hashes) - GRAM + 1)
    grams = run_hashes(hashes, at, at + GRAM)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))


def _texts(block: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, hash of the word sequence, word hashes) of the texts with LEAST words or more."""
    words = Words(block.column(column))
    whole = run_hashes(words.hash, words.first[:-1], words.first[1:])
    for i in np.flatnonzero(words.n >= LEAST):
        yield i, int(whole[i:i + 1].view(np.int64)[0]), words.hash[words.first[i]:words.first[i + 1]]


def _roots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = kept_starts(hashes)
    starts = starts[starts + ROOT <= len(hashes)]
    return starts, run_hashes(hashes, starts, starts + ROOT).view(np.int64)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, th, n) of documents, and rows (null, th, root) with kind 1 of the kept suffixes of each text."""
    met = set()
    for block in blocks(batches, "text"):
        rows, ths, ns, roots, of = [], [], [], [], []
        for i, th, hashes in _texts(block, 1):
            rows.append(i)
            ths.append(th)
            ns.append(len(hashes))
            if th not in met:
                met.add(th)
                own = np.unique(_roots(hashes)[1])
                roots.append(own)
                of.append(np.full(len(own), th))
        if rows:
            yield pa.RecordBatch.from_arrays([block.column(0).take(pa.array(rows)), pa.array(ths, pa.int64()), pa.array(ns, pa.int64()),
                                              pa.array(np.zeros(len(rows), np.int8))], names=["doc_id", "th", "v", "kind"])
            total = np.concatenate(roots) if roots else np.zeros(0, np.int64)
            if len(total):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(total), pa.int64()), pa.array(np.concatenate(of)), pa.array(total),
                                                  pa.array(np.ones(len(total), np.int8))], names=["doc_id", "th", "v", "kind"])


_ENTRY = pa.schema([("root", pa.int64()), ("after", pa.binary()), ("before", pa.binary()), ("th", pa.int64()), ("at", pa.int32()), ("n", pa.int32()),
                    ("ats", pa.binary())])


def _entries(bits):
    """Rows of the kept suffixes whose root is in the filter: the SIDE words behind the root and the SIDE
    words before the start (nearest first), as 32-bit numbers.  Suffixes of a text that agree in all of
    that are one row, with the first start and all starts (`ats`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, met = bits.value, set()
        for block in blocks(batches, "text"):
            out, places = [[] for _ in range(6)], []
            for _, th, hashes in _texts(block, 0):
                if th in met:
                    continue
                met.add(th)
                starts, roots = _roots(hashes)
                bit = roots & np.int64(HASH_BITS - 1)
                use = (table[bit >> 6] >> (bit & 63)) & 1 == 1
                starts, roots = starts[use], roots[use]
                if not len(starts):
                    continue
                short = (hashes >> np.uint64(32)).astype(">u4")
                padded = np.concatenate([np.zeros(SIDE, ">u4"), short, np.zeros(SIDE, ">u4")])
                after = padded[(starts + ROOT + SIDE)[:, None] + np.arange(SIDE)]
                before = padded[(starts + SIDE - 1)[:, None] - np.arange(SIDE)]
                room = np.stack([np.minimum(starts, SIDE), np.minimum(len(hashes) - ROOT - starts, SIDE)], axis=1).astype(">u4")
                whole = np.concatenate([roots.view(">u4").reshape(-1, 2), after, before, room], axis=1)
                digest = run_hashes(whole.ravel().astype(np.uint64) + np.uint64(1), np.arange(len(whole)) * whole.shape[1],
                                    np.arange(1, len(whole) + 1) * whole.shape[1])
                _, first, group = np.unique(digest, return_index=True, return_inverse=True)
                order = np.argsort(group, kind="stable")
                places += [p.astype(np.int32).tobytes() for p in np.split(starts[order], np.cumsum(np.bincount(group))[:-1])]
                starts, roots, after, before = starts[first], roots[first], after[first], before[first]
                for column, values in zip(out, (roots, after, before, np.full(len(starts), th), starts, np.full(len(starts), len(hashes)))):
                    column.append(values)
            if out[0]:
                root, after, before, th, at, n = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(root), _binary(after), _binary(before), pa.array(th), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(places, pa.binary())], schema=_ENTRY)
    return run


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of numbers as binary values of one length."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * 4
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(rows)])


def _unpacked(column: pa.Array) -> np.ndarray:
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], ">u4", offset=int(off[0]), count=len(column) * SIDE).reshape(-1, SIDE)


def _all_starts(column: pa.Array, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) for every start of the rows k."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) // 4
    starts = np.frombuffer(column.buffers()[2], np.int32)
    size = off[k + 1] - off[k]
    at = np.repeat(off[k] - np.cumsum(size) + size, size) + np.arange(size.sum())
    return np.repeat(np.arange(len(k)), size), starts[at]


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of equal words from the left, per row."""
    differ = np.concatenate([x != y, np.ones((len(x), 1), bool)], axis=1)
    return differ.argmax(axis=1)


_MATCH = pa.schema([("root", pa.int64()), ("th", pa.int64()), ("at", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])


def _neighbours(to_right: bool):
    """Sorted entries to matches (root, th, at, start, end), and, for entries whose end on this side is
    not final, rows with start = -1 and as end the number of words that any match has on this side at most."""
    def rows(root, th, at, start, end):
        if len(root):
            yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(th), *(pa.array(np.asarray(c).astype(np.int32)) for c in (at, start, end))], schema=_MATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = LEAST if to_right else SIDE
        held, reach, final = None, unknown, False  # the last entry, and what its left neighbour says; the first has none here
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            batch = table.to_batches()[0]
            root, th, at, n = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 3, 4, 5))
            after, before = _unpacked(batch.column(1)), _unpacked(batch.column(2))
            right = ROOT + np.minimum(_agree(after[:-1], after[1:]), np.minimum(n[:-1] - at[:-1], n[1:] - at[1:]) - ROOT)
            left = np.minimum(_agree(before[:-1], before[1:]), np.minimum(at[:-1], at[1:]))
            same = root[:-1] == root[1:]
            match = same & (th[:-1] != th[1:]) & (left + right >= LEAST)
            for i in (0, 1):
                k = np.flatnonzero(match) + i
                row, start = _all_starts(batch.column(6), k)
                # starts of a row whose matches overlap are one stretch
                begins = np.r_[True, (row[1:] != row[:-1]) | (np.diff(start) > (left + right)[match][row[1:]])] if len(row) else np.zeros(0, bool)
                ends = np.r_[begins[1:], True] if len(row) else begins
                own = row[begins]
                yield from rows(root[k][own], th[k][own], at[k][own], start[begins] - left[match][own], start[ends] + right[match][own])
            agree = np.where(same, right if to_right else left, -1)
            on_left, on_right = np.r_[reach, agree], np.r_[agree, -1]
            good_left, good_right = np.r_[final, match], np.r_[match, False]
            most = np.maximum(on_left, on_right)
            done = (good_left & (on_left == most)) | (good_right & (on_right == most)) | (most < 0)
            k = np.flatnonzero(~done[:-1])
            yield from rows(root[k], th[k], at[k], np.full(len(k), -1), most[k])
            held, reach, final = batch.slice(batch.num_rows - 1), int(on_left[-1]), bool(good_left[-1])
        if held is not None:  # its right neighbour is in another range
            yield from rows(held.column(0).to_numpy(), held.column(3).to_numpy(), held.column(4).to_numpy(), [-1], [unknown])
    return run


_STRETCH = pa.schema([("stretch", pa.int64()), ("th", pa.int64()), ("start", pa.int32())])


def _stretches(all_starts: bool, roots=None, wanted=None):
    """Hashes of the stretches of LEAST words around entries: l words before the start, LEAST - l from it
    on.  With `all_starts`, of every start of an entry, for l from its `lo` to its `hi`; else of the first
    start, for entries whose root and stretches whose hash pass the filters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            if roots is not None:
                batch = batch.filter(in_filter(roots.value, pa.array(batch.column(0).to_numpy() & np.int64(FILTER_BITS - 1))))
            if not batch.num_rows:
                continue
            batch = pa.Table.from_batches([batch]).combine_chunks().to_batches()[0]
            if all_starts:
                row, start = _all_starts(batch.column(6), np.arange(batch.num_rows))
            else:
                row, start = np.arange(batch.num_rows), batch.column(4).to_numpy()
            root, th, n = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 3, 5))
            after, before = _unpacked(batch.column(1)).astype(np.uint64), _unpacked(batch.column(2)).astype(np.uint64)
            rights, lefts = [root.view(np.uint64)], [np.zeros(len(root), np.uint64)]
            for i in range(SIDE):
                rights.append(mix(rights[-1] * step + after[:, i]))
                lefts.append(mix(lefts[-1] * step + before[:, i] + np.uint64(1)))
            for l in range(SIDE + 1):
                key = mix(rights[SIDE - l] ^ lefts[l] * np.uint64(2 * l + 1)).view(np.int64)[row]
                use = (start >= l) & (start + LEAST - l <= n[row])
                if all_starts:
                    use &= ((batch.column(7).to_numpy() <= l) & (l <= batch.column(8).to_numpy()))[row]
                if wanted is not None:
                    at = key & np.int64(HASH_BITS - 1)
                    use &= (wanted.value[at >> 6] >> (at & 63)) & 1 == 1
                if use.any():
                    yield pa.RecordBatch.from_arrays([pa.array(key[use]), pa.array(th[row][use]), pa.array((start[use] - l).astype(np.int32))], schema=_STRETCH)
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(th, spans as pairs) to (th, n_repeated, spans): overlapping and touching spans become one."""
    for batch in batches:
        counts, texts = [], []
        for pairs in batch.column(1).to_pylist():
            out = []
            for start, end in sorted((p["start"], p["end"]) for p in pairs):
                if out and start <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], end)
                else:
                    out.append([start, end])
            counts.append(sum(b - a for a, b in out))
            texts.append(",".join(f"{a}:{b}" for a, b in out))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], names=["th", "n_repeated", "spans"])


def _settled(entries: DataFrame, unsettled: DataFrame) -> DataFrame:
    """(th, start, end) of the stretches of LEAST words around unsettled entries that another text has.

    Only their own stretches are listed; of all other entries a stretch is passed
    on if it is in a fixed-size filter of those, so the texts' suffixes are not
    shuffled again, and a root with very many of them stays where it is.
    """
    sc = entries.sparkSession.sparkContext
    stretch = "stretch bigint, th bigint, start int"
    names = entries.columns
    open_ = (passing(entries.withColumn("id", F.xxhash64("root", "th", "at")), "id", sc.broadcast(id_filter(unsettled, "id", hashed=True)))
             .join(unsettled, ["root", "th", "at", "id"]).select(*names, "lo", "hi"))
    own = staged(open_.mapInArrow(_stretches(True), stretch), "open-stretches")
    roots = sc.broadcast(id_filter(unsettled, "root", hashed=True))
    wanted = sc.broadcast(id_filter(own, "stretch", hashed=True, size=HASH_BITS))
    others = entries.mapInArrow(_stretches(False, roots, wanted), stretch)
    twice = (own.unionByName(others).groupBy("stretch").agg(F.min("th").alias("lo"), F.max("th").alias("hi"))
             .filter("lo <> hi").select("stretch"))
    return own.join(twice, "stretch").select("th", "start", (F.col("start") + LEAST).alias("end"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Per document with a passage that another one has as well: doc_id, n_words, n_repeated (words
    in passages), spans (start:end in words, end exclusive, comma-joined) and first_copy, the smallest
    doc_id with the same word sequence (null if there is no other)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    survey = staged(docs.mapInArrow(_survey, "doc_id bigint, th bigint, v bigint, kind tinyint"), "suffix-survey")
    rows = staged(survey.filter("kind = 0").select("doc_id", "th", F.col("v").alias("n_words")), "long-texts")
    shared = (survey.filter("kind = 1").groupBy(F.col("v").alias("root")).agg(F.min("th").alias("lo"), F.max("th").alias("hi"))
              .filter("lo <> hi").select("root"))
    bits = spark.sparkContext.broadcast(id_filter(shared, "root", hashed=True, size=HASH_BITS))
    release(spark, survey)
    entry = "root bigint, after binary, before binary, th bigint, at int, n int, ats binary"
    entries = staged(docs.select("text").mapInArrow(_entries(bits), entry), "suffixes")
    bits.unpersist()
    found = []
    for to_right in (True, False):
        order = ["root", "after", "before", "th", "at"] if to_right else ["root", "before", "after", "th", "at"]
        found.append(staged(entries.repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order).select(*_ENTRY.names)
                            .mapInArrow(_neighbours(to_right), "root bigint, th bigint, at int, start int, end int"), "matches"))
        release(spark)
    most = [f.filter("start < 0").select("root", "th", "at", *[(F.col("end") if i == k else F.lit(None).cast("int")).alias(c)
                                                             for i, c in enumerate(("right", "left"))]) for k, f in enumerate(found)]
    unsettled = (most[0].unionByName(most[1]).groupBy("root", "th", "at").agg(F.max("right").alias("right"), F.max("left").alias("left"))
                 .filter(f"right IS NULL OR left IS NULL OR right + left >= {LEAST}")
                 # so many words before the start a match can have that is not known yet
                 .select("root", "th", "at", F.greatest(F.lit(0), F.lit(LEAST) - F.coalesce("right", F.lit(LEAST))).cast("int").alias("lo"),
                         F.coalesce("left", F.lit(SIDE)).cast("int").alias("hi")))
    settled = _settled(entries, staged(unsettled.withColumn("id", F.xxhash64("root", "th", "at")), "unsettled"))
    found = found[0].unionByName(found[1])
    copies = rows.groupBy("th").agg(F.min("doc_id").alias("first_copy"), F.count(F.lit(1)).alias("n_copies"), F.first("n_words").alias("n"))
    copies = staged(copies.filter("n_copies > 1"), "copies")
    whole = copies.select("th", F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))
    spans = found.filter("start >= 0").select("th", "start", "end").unionByName(settled).unionByName(whole)
    merged = (spans.groupBy("th").agg(F.collect_list(F.struct("start", "end")).alias("pairs"))  # of one text
              .mapInArrow(_merge, "th bigint, n_repeated bigint, spans string"))
    return (rows.join(merged, "th").join(copies.select("th", "first_copy"), "th", "left")
            .select("doc_id", "n_words", "n_repeated", "spans", "first_copy"))
