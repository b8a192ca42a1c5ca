"""Periodic runs of words by recompression, and texts with their repeats collapsed.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and length >= max(LEAST, TIMES * q) that no neighbouring word extends
keeping period q.

The words of a block of texts are compressed into a run-length grammar: block
compression replaces every maximal repetition of a symbol by a symbol for (symbol,
count), pair compression splits the symbols into left and right ones and replaces
every pair (left, right); the two alternate until each text is one symbol or
nearly so.  Equal stretches get equal symbols, wherever they are, except at their
two ends.  So the longest common extension of two places (forward or backward) is
read off the grammar: climb while the symbols agree, then descend along the first
pair of symbols that differ.  All queries of a block climb and descend together.

Candidates lie on a harmonic grid: words p apart agree in at least
max(LEAST, TIMES * p) - p places of a run of period p, so one of the places that
are multiples of that number lies among them.  The extensions of (place, place + p)
in both directions give the whole stretch.  A stretch of period p that also has a
smaller period is found for that one as well (by Fine and Wilf, since it has four
periods), with the same ends, and the smallest stays.

Defined results: a null text, an empty one or one without words has no runs and
collapses to the empty text; texts are compressed whole, whatever their length (a
text is never cut; a block holds one text at least); repeated rows give repeated
results; an empty table gives an empty one; other columns are ignored, whatever
their names.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import WORD_SPLIT, blocks
from lakefold.llm.words import Words, mix

LEAST, TIMES = 6, 4
LEVELS = 200         # pair compressions at most; what is left then is compared symbol by symbol
QUERIES = 1 << 20    # grid places looked at together

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Grammar:
    """The levels of the compression of `symbols`; `fence` marks places that no symbol reaches over.

    `names[t]` are the symbols of level t, `up[t]` the number of the symbol of level t + 1 that
    covers each, `begin[t]` where each symbol of level t + 1 begins in level t, and `blocks[t]`
    whether that level came from block or from pair compression.
    """

    def __init__(self, symbols: np.ndarray, fence: np.ndarray):
        self.names, self.up, self.begin, self.blocks = [symbols], [], [], []
        texts = int(fence.sum())
        for t in range(LEVELS):
            if len(self.names[-1]) <= 2 * texts + 2:
                break
            fence = self._level(fence, True, t)
            fence = self._level(fence, False, t)

    def _level(self, fence: np.ndarray, block: bool, t: int) -> np.ndarray:
        s = self.names[-1]
        if block:
            head = np.ones(len(s), bool)
            head[1:] = s[1:] != s[:-1]
        else:
            left = ((s >> np.uint64(t % 64)) & np.uint64(1)).astype(bool)
            joined = left[:-1] & ~left[1:] & ~fence[:-1] & ~fence[1:]
            other = ~left[:-1] & left[1:] & ~fence[:-1] & ~fence[1:]
            if other.sum() > joined.sum():  # the same choice for the whole level, so equal stretches are cut alike
                joined = other
            head = np.ones(len(s), bool)
            head[1:] = ~joined
        begin = np.flatnonzero(head)
        size = np.diff(np.append(begin, len(s)))
        name = s[begin]
        many = size > 1
        if block:
            name[many] = mix(name[many] * np.uint64(0x9E3779B97F4A7C15) + size[many].astype(np.uint64))
        else:
            name[many] = mix(mix(name[many]) + s[begin[many] + 1] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))
        self.names.append(name)
        self.up.append(np.append(np.cumsum(head) - 1, len(begin)))
        self.begin.append(np.append(begin, len(s)))
        self.blocks.append(block)
        return fence[begin]

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols from x on equal those from y on (x and y differ, and a fence follows both)."""
        return self._extend(x, y, 0) - x

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols before x equal those before y."""
        return x - self._extend(x, y, 1)

    def _extend(self, x: np.ndarray, y: np.ndarray, back: int) -> np.ndarray:
        """Where the common stretch that begins (or, backward, ends) at x and y ends, seen from x.

        A place of a level is a border between its symbols.  Forward looks at the symbol after it,
        backward at the one before it.  Going up, a place inside a symbol of the next level first moves
        to that symbol's end; going down, two symbols that differ give way to what they are made of.
        """
        x, y = x.copy(), y.copy()
        found = np.zeros(len(x), np.int64)  # the level on which the symbols were seen to differ
        live, top = np.arange(len(x)), len(self.up)
        step = -1 if back else 1
        for t in range(top):
            s, up, begin = self.names[t], self.up[t], self.begin[t]
            a, b = x[live], y[live]
            same = s[a - back] == s[b - back]
            found[live[~same]] = t
            live, a, b = live[same], a[same], b[same]
            if not len(live):
                break
            ua, ub = up[a], up[b]
            inside = (begin[ua] != a) | (begin[ub] != b)
            if inside.any():
                i, a1, b1 = live[inside], a[inside], b[inside]
                if self.blocks[t]:
                    ka, kb = ((a1 - begin[up[a1 - 1]], b1 - begin[up[b1 - 1]]) if back else
                              (begin[up[a1] + 1] - a1, begin[up[b1] + 1] - b1))
                    k = np.minimum(ka, kb)
                    x[i], y[i] = a1 + step * k, b1 + step * k
                    over = ka != kb
                    found[i[over]] = t
                    gone = np.zeros(len(live), bool)
                    gone[np.flatnonzero(inside)[over]] = True
                    live = live[~gone]
                else:
                    x[i], y[i] = a1 + step, b1 + step
            x[live], y[live] = up[x[live]], up[y[live]]
        s = self.names[top]
        while len(live):  # the symbols of the last level, of which texts have few
            same = s[x[live] - back] == s[y[live] - back]
            found[live[~same]] = top
            live = live[same]
            x[live] += step
            y[live] += step
        for t in range(top, 0, -1):
            at = np.flatnonzero(found == t)
            if not len(at):
                continue
            s, begin = self.names[t - 1], self.begin[t - 1]
            a, b = begin[x[at]], begin[y[at]]
            same = s[a - back] == s[b - back]
            if self.blocks[t - 1]:
                ka = a - begin[x[at] - 1] if back else begin[x[at] + 1] - a
                kb = b - begin[y[at] - 1] if back else begin[y[at] + 1] - b
                move = np.where(same, np.minimum(ka, kb), 0)
            else:
                move = same.astype(np.int64)
            x[at], y[at] = a + step * move, b + step * move
            found[at] = t - 1
        return x


def find_runs(symbols: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run, by text, start and period; text i has the symbols
    first[i]:first[i + 1]."""
    if times < 2:
        raise ValueError("a stretch has a period of its own only from two periods on")
    n = np.diff(first)
    own = np.repeat(np.arange(len(n)), n)
    # a fence before the first text, between texts and after the last; no two fences are equal
    at = np.arange(len(symbols)) + own + 1
    padded = mix(np.arange(len(symbols) + len(n) + 1, dtype=np.uint64) + np.uint64(0xD6E8FEB86659FD93))
    fence = np.ones(len(padded), bool)
    fence[at] = False
    padded[at] = symbols
    origin = first[:-1] + np.arange(len(n)) + 1  # where each text begins among the padded symbols
    periods = np.maximum(0, np.where(n >= least, n // times, 0))
    text = np.repeat(np.arange(len(n)), periods)
    p = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    apart = np.maximum(least, times * p) - p
    places = -(-np.maximum(0, n[text] - p) // apart)
    grammar, out = None, []
    ends = np.cumsum(places)
    a = 0
    while a < len(text):  # as many periods as QUERIES places allow, one at least
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + QUERIES, side="right")))
        number = places[a:b]
        of = np.repeat(np.arange(a, b), number)
        i = (np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)) * apart[of] + origin[text[of]]
        j = i + p[of]
        same = padded[i] == padded[j]  # an extension of nothing needs no grammar
        of, i, j = of[same], i[same], j[same]
        a = b
        if not len(of):
            continue
        grammar = grammar or Grammar(padded, fence)
        start = i - grammar.backward(i, j)
        length = j + grammar.forward(i, j) - start
        ok = length >= np.maximum(least, times * p[of])
        found = np.stack([text[of][ok], (start - origin[text[of]])[ok], length[ok], p[of][ok]])
        out.append(np.unique(found, axis=1))
    if not out:
        return tuple(np.zeros((4, 0), np.int64))
    text, start, length, period = np.concatenate(out, axis=1)
    order = np.lexsort((period, length, start, text))  # the smallest period of a stretch comes first
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def dropped_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words a run contains after its first period."""
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    return np.cumsum(cover)[:n] > 0


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """`key`, `runs` (start, length, period; by start, then period) and `collapsed`: the words that
    no run contains after its first period, joined by one space."""
    df = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            words = Words(block.column(1))
            own, start, length, period = find_runs(words.hash, words.first, least, times)
            at = np.searchsorted(own, np.arange(block.num_rows + 1))
            collapsed = []
            for i, body in enumerate(block.column(1).cast(pa.large_binary()).to_pylist()):
                split = (body or b"").split()  # at the bytes that separate words
                if at[i] < at[i + 1]:
                    part = slice(at[i], at[i + 1])
                    split = compress(split, ~dropped_words(len(split), start[part], length[part], period[part]))
                collapsed.append(b" ".join(split))
            structs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(run_type.value_type))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), structs, type=run_type),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names=["key", "runs", "collapsed"])

    kind = df.schema["key"].dataType.simpleString()
    return df.mapInArrow(run, f"key {kind}, runs {RUNS}, collapsed string").withColumnRenamed("key", key)


def _planted(text: str, key: str) -> Column:
    """The text, or, where crc32 of the id ends in 0, its words with a periodic tail."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")

    def tailed(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    edited = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, tailed(w))), 1)  # words are split once
    return F.when(h % 10 == 0, edited).otherwise(F.col(text))


def run_report(docs: DataFrame) -> DataFrame:
    """Per document, after every tenth one has been given a periodic tail: number of runs, the longest
    run, and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs.select("doc_id", _planted("text", "doc_id").alias("text")))
    longest = F.reduce("runs", F.get("runs", F.lit(0)),  # runs come by start, then period
                       lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), longest.alias("best"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
