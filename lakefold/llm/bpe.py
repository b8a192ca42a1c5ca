"""Byte-level BPE encoding and decoding by merge replay.

Texts are taken in blocks of bounded size.  The distinct pretokens of a block
form its corpus: an inverted index lists, for each merge rank, the positions
whose symbol pair has that rank.  Merges are applied in rank order, each to all
of its positions at once, and only the pairs beside a merged one are looked up
again.  Documents are then put together from the encoded pretokens.

A pretoken that is itself a token is that token; otherwise the pair of lowest
rank, leftmost first, is merged until none is left.  A merge can create a pair
of a lower rank than its own; where that meets further pairs of the same rank
in the same pretoken, that pretoken is encoded alone, pair by pair.

Defined results: a null or empty text has no tokens; texts of any length are
encoded whole; repeated rows give repeated results; an empty table gives an
empty table; other columns than the key and the text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import blocks
from lakefold.llm.words import ProcessCache

BLOCK_TEXT = 8 << 20  # bytes of text whose distinct pretokens are replayed together
NONE = np.int32(2**31 - 1)
_LOADED = ProcessCache()


def read_ranks(path: str) -> bytes:
    """The rank file as it is (about 50,000 lines); it travels to the tasks as a broadcast."""
    with open(path, "rb") as f:
        return f.read()


class Merges:
    """Token bytes by id, and the rank of every pair of tokens that makes a token."""

    def __init__(self, data: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int32)[order]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def encode_alone(self, piece: bytes) -> list[int]:
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if rank == NONE:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and bounds: piece i has ids[bounds[i]:bounds[i + 1]]."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        rest = np.flatnonzero(whole < 0)
        ids, bounds = self._replay([pieces[i] for i in rest])
        n = np.ones(len(pieces), np.int64)
        n[rest] = np.diff(bounds)
        out_bounds = np.concatenate([[0], np.cumsum(n)])
        out = np.empty(out_bounds[-1], np.int32)
        known = whole >= 0
        out[out_bounds[:-1][known]] = whole[known]
        fill = np.ones(len(out), bool)
        fill[out_bounds[:-1][known]] = False
        out[fill] = ids
        return out, out_bounds

    def _replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        if not total:
            return np.zeros(0, np.int32), np.zeros(len(pieces) + 1, np.int64)
        symbol = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        after = np.arange(1, total + 1, dtype=np.int32)
        after[ends[size > 0] - 1] = -1
        before = np.arange(-1, total - 1, dtype=np.int32)
        before[(ends - size)[size > 0]] = -1
        alive = np.ones(total, bool)
        rank = np.full(total, NONE, np.int32)
        index: dict[int, list[np.ndarray]] = {}
        pending: list[int] = []
        alone: set[int] = set()

        def note(at: np.ndarray) -> np.ndarray:
            """Look up the pairs that start at `at` and enter them in the index."""
            follows = after[at]
            found = np.full(len(at), NONE, np.int32)
            has = follows >= 0
            found[has] = self.pair_ranks(symbol[at[has]], symbol[follows[has]])
            rank[at] = found
            use = np.flatnonzero(found != NONE)
            if len(use):
                use = use[np.argsort(found[use], kind="stable")]
                values = found[use]
                cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
                for part in np.split(use, cuts) if len(cuts) else (use,):
                    r = int(found[part[0]])
                    if r in index:
                        index[r].append(at[part])
                    else:
                        index[r] = [at[part]]
                        heapq.heappush(pending, r)
            return found

        note(np.flatnonzero(after >= 0).astype(np.int32))
        while pending:
            r = heapq.heappop(pending)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:
                chained = np.zeros(len(at), bool)
                chained[1:] = after[at[:-1]] == at[1:]
                if chained.any():  # overlapping pairs: every second one, from the left
                    i = np.arange(len(at))
                    at = at[(i - np.maximum.accumulate(np.where(chained, 0, i))) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            symbol[at] = r
            after[at] = beyond
            alive[gone] = False
            rank[gone] = NONE
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            left = before[at]
            touched = np.concatenate([at, left[left >= 0]])
            if len(touched) > 1:
                touched = np.unique(touched)
            lower = note(touched) <= r
            if lower.any():
                merged, count = np.unique(piece[at], return_counts=True)
                alone.update(np.intersect1d(merged[count > 1], piece[touched[lower]]).tolist())
        own, ids = piece[alive], symbol[alive]
        bounds = np.searchsorted(own, np.arange(len(pieces) + 1))
        if alone:
            parts = [ids[bounds[i]:bounds[i + 1]] for i in range(len(pieces))]
            for i in alone:
                parts[i] = np.array(self.encode_alone(pieces[i]), np.int32)
            ids = np.concatenate(parts)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, bounds


def merges_of(data: bytes) -> Merges:
    """One table per worker process."""
    key = hash(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Merges(data)
    return _LOADED[key]


class _Numbered(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def encode_texts(merges: Merges, split, texts: pa.Array) -> list[np.ndarray]:
    """Ids of each text of a block; `split` finds the pretokens of a text."""
    numbers = _Numbered()
    number = numbers.__getitem__
    words = [np.fromiter(map(number, split(t)), np.int32) if (t := x.as_py()) else np.zeros(0, np.int32) for x in texts]
    ids, bounds = merges.encode_pieces([w.encode() for w in numbers])
    size, start = np.diff(bounds).astype(np.int32), bounds[:-1].astype(np.int32)
    out = []
    for w in words:
        n = size[w]
        ends = np.cumsum(n, dtype=np.int32)
        total = int(ends[-1]) if len(n) else 0
        out.append(ids[np.repeat(start[w] - ends + n, n) + np.arange(total, dtype=np.int32)].astype("<u4"))
    return out


def decode_ids(merges: Merges, ids: np.ndarray) -> bytes:
    return b"".join(map(merges.tokens.__getitem__, ids.tolist()))


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_tokens` and `ids` (little-endian unsigned 32-bit integers, one after another)."""
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))  # size fixed by the vocabulary
    df = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, split = merges_of(data.value), regex.compile(pattern).findall
        for block in blocks(batches, "text", BLOCK_TEXT):
            ids = encode_texts(merges, split, block.column(1))
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([len(x) for x in ids], pa.int64()),
                                              pa.array([x.tobytes() for x in ids], pa.binary())], names=["key", "n_tokens", "ids"])

    kind = df.schema["key"].dataType.simpleString()
    return df.mapInArrow(run, f"key {kind}, n_tokens bigint, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """All columns of `encoded`, and `decoded`, the bytes that `ids` stand for."""
    data = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = merges_of(data.value)
        for block in blocks(batches, "ids", BLOCK_TEXT):
            ids = block.column(block.schema.get_field_index("ids"))
            out = [decode_ids(merges, np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: its number of tokens and the digests of its ids and of the bytes decoded from them.
    Encoding and decoding share a task, so ids and bytes are digested where they are made."""
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, split = merges_of(data.value), regex.compile(pattern).findall
        for block in blocks(batches, "text", BLOCK_TEXT):
            ids = encode_texts(merges, split, block.column(1))
            digests = [[hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(decode_ids(merges, x)).hexdigest() for x in ids]]
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array([len(x) for x in ids], pa.int64()), *(pa.array(d, pa.string()) for d in digests)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return df.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
