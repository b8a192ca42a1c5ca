"""The trie of rebuilt conversations, from fingerprints that compose.

A conversation is rebuilt from the first turns of a base conversation (the head)
and its own turns after as many (the suffix).  Rebuilt texts are never made.  The
fingerprint of a sequence of turns is (length, sum of t_i * x^i mod 2^61 - 1), t_i
the hash of turn i, and (m, u) * (n, v) = (m + n, u + x^m * v): a monoid, and on
prefixes a quotient exists as well.  So the fingerprint of every rebuilt prefix is
head * (own prefix / own head), out of the running products of the stored turns.
There are two such fingerprints, with different hashes and different x.

The turns are dealt out by ranges of (conversation, turn), so a long conversation
is spread over tasks; each task multiplies up its own stretch, and what a stretch
takes over from the ones before it is the product of one element for each range.

Equal (depth, fingerprints) are a node.  Equality is verified: turns with one
hash must have one text, and the prefixes of a node must end in turns of one hash;
as that holds for the node above as well, the sequences are equal by induction.
A collision fails the job (another SEED then separates the texts).

Sums over subtrees need no walk.  A conversation represents a node if it is the
node's smallest member; going down it does so from some depth on.  So a node's
children, leaves and repeated words are sums over its members of what each
represents, and no node is sent to its ancestors.

Defined results: null role or text is empty; turns come by turn (null first), then
role and text; repeated rows are turns of their own; rows without conv_id belong
to no conversation and are left out; a conversation whose base is absent has no
head; a conversation may be long or its texts empty; an empty table gives no node,
not even the root; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakefold.llm.common import shuffle_width, staged

PRIME = (1 << 61) - 1
BASES = (0x1A2B3C4D5E6F708, 0x0F1E2D3C4B5A697)  # x of either fingerprint
SEED = 1
HEAD_MOST = 3        # turns of a base conversation that may be taken over
ENDS_BLOCK = 4096    # ids of a text of ids
PREFIX_CHARS = 64    # of role and text, for the borders of ranges

_LOW = np.uint64((1 << 31) - 1)


def _fold(t: np.ndarray) -> np.ndarray:
    t = (t & np.uint64(PRIME)) + (t >> np.uint64(61))
    t = (t & np.uint64(PRIME)) + (t >> np.uint64(61))
    return np.where(t == np.uint64(PRIME), np.uint64(0), t)


def multiply(a, b) -> np.ndarray:
    """a * b mod 2^61 - 1, of numbers below it."""
    a, b = np.asarray(a, np.uint64), np.asarray(b, np.uint64)
    a1, a0, b1, b0 = a >> np.uint64(31), a & _LOW, b >> np.uint64(31), b & _LOW
    mid = a1 * b0 + a0 * b1
    return _fold(np.uint64(2) * (a1 * b1) + (mid >> np.uint64(30)) + ((mid & np.uint64((1 << 30) - 1)) << np.uint64(31)) + a0 * b0)


def _powers(x: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, multiply(out, pow(x, len(out), PRIME))])
    return out[:n]


def _running(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums mod 2^61 - 1 from row start[i] to row i."""
    total = []
    for part in (values >> np.uint64(32), values & np.uint64(0xFFFFFFFF)):
        sums = np.cumsum(part)
        total.append(_fold(sums - (sums - part)[start]))
    return _fold(multiply(total[0], np.uint64(1 << 32)) + total[1])


def compose(u: tuple, v: tuple) -> tuple:
    """The product of two stretches (turns, fingerprint, fingerprint, words)."""
    return (u[0] + v[0], *((u[i + 1] + pow(x, u[0], PRIME) * v[i + 1]) % PRIME for i, x in enumerate(BASES)), u[3] + v[3])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and running products of the turns of each conversation, as far as this range holds them."""
    last, done = None, None  # the conversation at hand, and its product so far
    for batch in batches:
        if not batch.num_rows:
            continue
        part, conv, words = (batch.column(i).to_numpy() for i in (0, 1, 4))
        turns = [batch.column(i).to_numpy().astype(np.uint64) for i in (2, 3)]
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        starts = np.flatnonzero(new)
        start = np.repeat(starts, np.diff(np.append(starts, len(conv))))
        k = np.arange(len(conv)) - start
        first = int(starts[1]) if len(starts) > 1 else len(conv)  # rows of the first conversation
        goes_on = last is not None and last == conv[0]
        until, before = [], []
        for i, (x, t) in enumerate(zip(BASES, turns)):
            term = multiply(t, _powers(x, len(conv))[k])
            run = _running(term, start)
            prior = _fold(run + np.uint64(PRIME) - term)
            if goes_on:
                shift, have = pow(x, done[0], PRIME), np.uint64(done[i + 1])
                run[:first] = _fold(multiply(run[:first], np.uint64(shift)) + have)
                prior[:first] = _fold(multiply(prior[:first], np.uint64(shift)) + have)
            until.append(run)
            before.append(prior)
        sums = np.cumsum(words)
        total = sums - (sums - words)[start]
        if goes_on:
            k[:first] += done[0]
            total[:first] += done[3]
        last, done = conv[-1], (int(k[-1]) + 1, int(until[0][-1]), int(until[1][-1]), int(total[-1]))
        columns = [part, conv, k, *(a.astype(np.int64) for a in (*until, *before, *turns)), words, total]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_SCANNED)


_SCANNED = ["part", "conv", "k", "u1", "u2", "b1", "b2", "t1", "t2", "w", "total"]


def _times(a: Column, b: Column) -> Column:
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def _mod(c: Column) -> Column:
    return F.pmod(c, F.lit(PRIME).cast("decimal(19,0)")).cast("bigint")


def _number(n: int) -> Column:
    return F.lit(n).cast("bigint")


def running_products(turns: DataFrame, seed: int = SEED) -> DataFrame:
    """Per turn: conv, k (its number, from 0), the fingerprints up to it (u1, u2) and before it (b1, b2), the
    turn's hashes (t1, t2), its words w, and the words up to it (total).  `turns` has conv, turn, role, text."""
    spark = turns.sparkSession
    order = [F.col("conv"), F.col("turn").asc_nulls_first()]
    near = [F.substring(c, 1, PREFIX_CHARS) for c in ("role", "text")]
    dealt = (turns.repartitionByRange(shuffle_width(spark), *order, *near).sortWithinPartitions(*order, "role", "text")
             .select(F.spark_partition_id().cast("bigint").alias("part"), "conv", *_hashes(seed),
                     F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("w")))
    scanned = staged(dealt.mapInArrow(_scan, ", ".join(f"{c} bigint" for c in _SCANNED)), "turns")
    ends = scanned.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"),
                                       F.max_by(F.struct(F.col("k") + 1, "u1", "u2", "total"), F.struct("conv", "k")).alias("tail")).collect()
    taken, conv, done = [], None, None  # a row for each range that goes on with a conversation
    for r in sorted(ends):
        tail = tuple(r["tail"])
        if conv == r["first"]:
            taken.append((r["part"], conv, *done, *(pow(x, done[0], PRIME) for x in BASES)))
            tail = compose(done, tail) if r["first"] == r["last"] else tail
        conv, done = r["last"], tail
    if not taken:
        return scanned.drop("part")
    before = spark.createDataFrame(taken, "part bigint, conv bigint, n bigint, c1 bigint, c2 bigint, cw bigint, x1 bigint, x2 bigint")
    joined = scanned.join(F.broadcast(before), ["part", "conv"], "left")  # bounded by the number of ranges

    def whole(name: str, i: int) -> Column:
        return F.when(F.col("n").isNull(), F.col(name)).otherwise(_mod(F.col(f"c{i}") + _times(F.col(f"x{i}"), F.col(name)))).alias(name)

    return joined.select("conv", (F.col("k") + F.coalesce("n", F.lit(0))).alias("k"), whole("u1", 1), whole("u2", 2), whole("b1", 1),
                         whole("b2", 2), "t1", "t2", "w", (F.col("total") + F.coalesce("cw", F.lit(0))).alias("total"))


def _hashes(seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(2 * seed + i), "role", "text"), _number(PRIME)).alias(f"t{i + 1}") for i in (0, 1)]


def _verify_turns(turns: DataFrame, seed: int) -> None:
    """One text for each pair of hashes."""
    text = F.struct("role", "text")
    clash = (turns.select(*_hashes(seed), text.alias("turn")).groupBy("t1", "t2").agg(F.min("turn").alias("a"), F.max("turn").alias("b"))
             .filter("a <> b").limit(1).count())
    if clash:
        raise RuntimeError("two turns have the same hashes: choose another seed")


def prefixes(turns: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], seed: int = SEED) -> DataFrame:
    """Per rebuilt conversation and depth 0, 1, ..: fingerprints f1, f2 of the prefix and p1, p2 of the one above,
    hashes t1, t2 and words w of its last turn, words `upto` it, and the conversation's whole depth and words."""
    t = running_products(turns, seed)
    places = range(HEAD_MOST)
    convs = t.groupBy("conv").agg((F.max("k") + 1).alias("n"), F.sum("w").alias("all_words"), *[
        F.max(F.when(F.col("k") == i, F.col(c))).alias(f"{c}_{i}") for i in places for c in ("t1", "t2", "w")])
    convs = convs.withColumns({"base": base(F.col("conv")), "h": F.least(head(F.col("conv")), F.lit(HEAD_MOST))})
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), *[
        F.col(f"{c}_{i}").alias(f"base_{c}_{i}") for i in places for c in ("t1", "t2", "w")])
    both = convs.join(bases, "base", "left").withColumn("hp", F.least("h", F.coalesce("base_n", F.lit(0))))

    def heads(prefix: str, i: int) -> Column:
        """Fingerprints of the first 0, 1, .. turns."""
        term = [_times(F.lit(pow(BASES[i - 1], j, PRIME)), F.coalesce(F.col(f"{prefix}t{i}_{j}"), _number(0))) for j in places]
        out = [_number(0)]
        for x in term:
            out.append(_mod(out[-1] + x))
        return F.array(*out)

    def words(prefix: str) -> Column:
        out = [_number(0)]
        for j in places:
            out.append(out[-1] + F.coalesce(F.col(f"{prefix}w_{j}"), _number(0)))
        return F.array(*out)

    at = lambda c, n: F.get(c, F.col(n).cast("int"))
    both = both.withColumns({**{f"bv{i}": heads("base_", i) for i in (1, 2)}, **{f"ov{i}": heads("", i) for i in (1, 2)},
                             "bw": words("base_"), "ow": words("")})
    shift = F.col("h") - F.col("hp")
    for i, x in enumerate(BASES, 1):  # x^(hp - h), and what is added to own prefixes times that
        both = both.withColumn(f"s{i}", F.get(F.array(*[_number(pow(x, -j, PRIME)) for j in range(HEAD_MOST + 1)]), shift.cast("int")))
        both = both.withColumn(f"a{i}", _mod(at(f"bv{i}", "hp") - _times(F.col(f"s{i}"), at(f"ov{i}", "h"))))
    both = both.withColumns({"aw": at("bw", "hp") - at("ow", "h"), "depths": F.col("hp") + F.greatest(F.col("n") - F.col("h"), F.lit(0))})
    both = both.withColumn("words", F.when(F.col("n") > F.col("h"), F.col("aw") + F.col("all_words")).otherwise(at("bw", "hp")))
    per = staged(both.select("conv", "h", "hp", "depths", "words", "s1", "s2", "a1", "a2", "aw", "bv1", "bv2", "bw",
                             *[F.col(f"base_{c}_{i}").alias(f"{c}_{i}") for i in places for c in ("t1", "t2", "w")]), "rebuilt")
    own = (t.join(per.select("conv", "h", "hp", "depths", "words", "s1", "s2", "a1", "a2", "aw"), "conv").filter("k >= h")
           .select("conv", (F.col("hp") + F.col("k") - F.col("h") + 1).alias("depth"),
                   *[_mod(F.col(f"a{i}") + _times(F.col(f"s{i}"), F.col(f"u{i}"))).alias(f"f{i}") for i in (1, 2)],
                   *[_mod(F.col(f"a{i}") + _times(F.col(f"s{i}"), F.col(f"b{i}"))).alias(f"p{i}") for i in (1, 2)],
                   "t1", "t2", "w", (F.col("aw") + F.col("total")).alias("upto"), "depths", "words"))

    def top(d: int) -> Column:
        """The prefix of depth d, taken from the base."""
        above = max(0, d - 1)
        last = {c: F.col(f"{c}_{above}") if d else _number(0) for c in ("t1", "t2", "w")}
        return F.struct(_number(d).alias("depth"), *[F.get(f"bv{i}", F.lit(d)).alias(f"f{i}") for i in (1, 2)],
                        *[F.get(f"bv{i}", F.lit(above)).alias(f"p{i}") for i in (1, 2)], *[last[c].alias(c) for c in last],
                        F.get("bw", F.lit(d)).alias("upto"))

    tops = F.slice(F.array(*[top(d) for d in range(HEAD_MOST + 1)]), F.lit(1), (F.col("hp") + 1).cast("int"))
    return own.unionByName(per.select("conv", "depths", "words", F.inline(tops)))


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the texts of each node, which come in order, one at a time."""
    node, state = None, None
    for batch in batches:
        out = []
        for *key, _, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if key == node:
                state.update(b"," + text.encode())
                continue
            if node is not None:
                out.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(text.encode())
        yield _digest_rows(out)
    if node is not None:
        yield _digest_rows([(*node, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["depth", "f1", "f2", "ends_sha256"])


def prefix_trie(conversations: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], seed: int = SEED) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256.  `base` and `head` give, from a conv_id, the conversation whose first turns it takes and how many
    (HEAD_MOST at most)."""
    spark: SparkSession = conversations.sparkSession
    turns = (conversations.filter(F.col("conv_id").isNotNull())
             .select(F.col("conv_id").cast("bigint").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text")))
    _verify_turns(turns, seed)
    rows = staged(prefixes(turns, base, head, seed), "prefixes")
    node = ["depth", "f1", "f2"]
    nodes = staged(rows.groupBy(*node).agg(
        F.min("conv").alias("conv"), F.max((F.col("depths") > F.col("depth")).cast("int")).alias("goes_on"),
        F.max(F.struct("p1", "p2")).alias("above"), F.max(F.col("upto") - F.col("w")).alias("upto_above")), "nodes")
    # from which depth on a conversation represents its prefixes, and the words up to there
    first = nodes.groupBy("conv").agg(
        F.min("depth").alias("since"), F.min_by(F.struct("above", "upto_above"), "depth").alias("there"),
        F.max((F.col("goes_on") == 0).cast("int")).alias("leaf")).select("conv", "since", "leaf", "there.above", "there.upto_above")
    parents = (first.filter("since > 0").select(F.col("conv").alias("child"), (F.col("since") - 1).alias("depth"), F.col("above.p1").alias("f1"), F.col("above.p2").alias("f2"))
               .join(nodes.select(*node, F.col("conv").alias("parent")), node).select("child", "parent"))
    marked = rows.join(first.drop("above"), "conv", "left")
    shared = F.coalesce("upto_above", "words") - (F.col("upto") - F.col("w"))  # words from here to where the conversation stands alone
    below = F.col("depth") + 1
    whole = marked.groupBy(*node).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.coalesce(((F.col("since") <= below) & (below <= F.col("depths"))).cast("bigint"), F.lit(0))).alias("n_children"),
        F.sum(F.coalesce(F.col("leaf").cast("bigint"), F.lit(0))).alias("n_leaves"),
        F.sum(F.greatest(shared, F.lit(0))).alias("saved_tokens"),
        F.max(F.when(F.col("since") < F.col("depth"), F.col("conv"))).alias("own_parent"),
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("t1", "t2") for f in (F.min, F.max)])
    same = (F.col("min_t1") == F.col("max_t1")) & (F.col("min_t2") == F.col("max_t2"))
    whole = whole.filter(F.when(same, F.lit(True)).otherwise(F.raise_error(F.lit("two prefixes have the same fingerprints: choose another seed"))))
    texts = (rows.filter("depth = depths").groupBy(*node, F.floor(F.col("conv") / ENDS_BLOCK).alias("part"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")))
    ends = (texts.repartition(shuffle_width(spark), *node).sortWithinPartitions(*node, "part")
            .mapInArrow(_end_digests, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string"))
    return (whole.join(ends, node, "left").join(parents, (F.col("conv_id") == F.col("child")) & F.col("own_parent").isNull() & (F.col("depth") > 0), "left")
            .select("conv_id", "depth", F.coalesce("own_parent", "parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of conversations that take 0 to 3 turns of the first conversation of their twenty."""
    return prefix_trie(conversations, lambda c: c - c % 20, lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)))
