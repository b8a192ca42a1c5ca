"""N-gram Jaccard join by prefix filters under several global orders.

A document is the set of its distinct five-word shingles (A-Z lower-cased;
words are `[^\\x20\\x09-\\x0D]+`; a text of one to four words is one shingle).
Two documents link when 100 * |A n B| >= 75 * |A u B|.

1. Documents with equal sets form a class; all further work is on classes.
2. First order: frequent shingles last, the rest by hash.  Linked classes share
   one of their first n - ceil(0.75 n) + 1 shingles.  Those are dealt out by
   shingle, and the meetings of each pair are counted.  Common shingles that
   were not counted lie behind the prefix that ends first, so the count and the
   rest of that set bound the overlap from above.
3. Second order: by another hash, frequent shingles last again.  Pairs that
   pass must also meet, under the same bound, in their prefixes of this order.
4. What is left is verified on the whole sets.

Which shingles are frequent is counted over all texts; it only shapes the
order, so results do not depend on it.  A shingle that still turns out to be in
more than GROUP prefixes is counted as frequent in another pass.  Classes that
have frequent shingles in their prefix, because they hold little else, form
clusters with those that share them: every member is compared with a few
pivots, and what is then not in the cluster's largest component is searched
against the whole cluster, block by block, so no link between components is
lost.

Defined results: null or empty texts have no set, link with nothing and are
their own component (component_id = doc_id); repeated rows and equal texts are
in one component; a null id takes part, and a component of null ids alone has a
null component_id; very long texts are used whole; an empty table gives an
empty result; only doc_id and text are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import blocks, filter_bit, id_filter, in_filter, release, shuffle_width, staged
from lakefold.llm.graph import components
from lakefold.llm.words import Words, mix

SHINGLE = 5
PERCENT = 75
GROUP = 256            # a shingle in more prefixes than this makes no pairs
FREQUENT = 32          # counted occurrences from which a shingle is ordered last
MOST_FREQUENT = 1 << 20  # bound of the broadcast list of frequent shingles (8 MB)
PIVOTS = 8
SEARCH_BLOCK = 256     # classes on each side of a block of the cluster search
COUNT_BYTES = 16 << 20  # text in which a shingle's repeats are counted locally
PASSES = 3             # over the first order at most, while shingles turn out to be frequent


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + 1


def least_overlap(na, nb):
    """The smallest overlap that links sets of these sizes."""
    return (PERCENT * (na + nb) + 99 + PERCENT) // (100 + PERCENT)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    hashes, bounds = Words(texts, lower=True).shingles(SHINGLE)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def class_key(tokens: np.ndarray) -> int:
    """A 64-bit digest of a set (its hashes added under two mixes, with its size)."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix(tokens ^ np.uint64(0xA5A5A5A5DEADBEEF))) ^ np.uint64(len(tokens)) * np.uint64(0x9E3779B97F4A7C15)
        return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def order_value(tokens: np.ndarray, frequent: np.ndarray, seed: int) -> np.ndarray:
    """31-bit places in a global order; frequent shingles have the last one."""
    value = (mix(tokens ^ np.uint64(seed)) >> np.uint64(33)).astype(np.int32)
    return np.where(_is_in(tokens, frequent), np.int32(2**31 - 1), value)


def _is_in(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    return frequent[at] == tokens


def most_overlap(common, na, nb, end_a, end_b):
    """Bound of the overlap of two sets with `common` shingles in both prefixes, which end at these places of the order."""
    rest_a, rest_b = na - prefix_length(na), nb - prefix_length(nb)
    return common + np.where(end_a < end_b, rest_a, np.where(end_b < end_a, rest_b, np.maximum(rest_a, rest_b)))


def ordered(tokens: np.ndarray, frequent: np.ndarray, seed: int) -> np.ndarray:
    """A set in one of the global orders: frequent shingles last, then by mixed hash."""
    return tokens[np.lexsort((mix(tokens ^ np.uint64(seed)), _is_in(tokens, frequent)))]


SEEDS = (0x51ED270B7F3C1A95, 0xC2B2AE3D27D4EB4F)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, th, key, n) of documents, and rows (null, null, shingle, -count) of shingles that repeat in a stretch of texts."""
    held, size = {}, 0

    def repeats():
        tokens, counts = np.unique(np.concatenate(list(held.values())), return_counts=True)
        use = counts > 1
        none = pa.nulls(int(use.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, pa.array(tokens[use].view(np.int64)),
                                           pa.array(-counts[use].astype(np.int64))], names=["doc_id", "th", "key", "n"])

    for block in blocks(batches, "text"):
        sets = sets_of(block.column(1))
        keys = [class_key(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([block.column(0), block.column(2), pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64())],
                                         names=["doc_id", "th", "key", "n"])
        held.update((k, s) for k, s in zip(keys, sets) if k is not None)
        size += block.column(1).nbytes
        if size >= COUNT_BYTES and held:
            yield repeats()
            held, size = {}, 0
    if held:
        yield repeats()


def _postings(frequent):
    """Rows (shingle, key, n, end) of each class's first prefix, with the place in the order where the
    prefix ends; n is negative where the shingle is frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, met = frequent.value, set()
        for block in blocks(batches, "text"):
            columns = [[], [], [], []]
            for tokens in sets_of(block.column(1)):
                n = len(tokens)
                key = class_key(tokens)
                if not n or key in met:  # copies in this task
                    continue
                met.add(key)
                p = prefix_length(n)
                first = ordered(tokens, known, SEEDS[0])[:p]
                end = int(order_value(first[-1:], known, SEEDS[0])[0])
                signed = np.where(_is_in(first, known), -n, n)
                for column, values in zip(columns, (first.view(np.int64), np.full(p, key), signed, np.full(p, end))):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(t)) for c, t in zip(columns, (np.int64, np.int64, np.int32, np.int32))],
                    names=["token", "key", "n", "end"])
    return run


_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("na", pa.int32()), ("nb", pa.int32()),
                  ("ea", pa.int32()), ("eb", pa.int32())])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by shingle to pairs that meet (a < b, sizes fit); rows (shingle, key, 0, known, 0, 0)
    for shingles that are frequent (known: 1) or turn out to be in more than GROUP prefixes (0)."""
    rest = np.zeros((4, 0), np.int64)
    open_large = None  # the shingle of a large group that may go on

    def large(token, key, known=0):
        zero = np.zeros(len(token), np.int64)
        return np.stack([token, key, zero, zero + known, zero, zero])

    def work(rows: np.ndarray, last: bool):
        nonlocal rest, open_large
        out = []
        hot = rows[2] < 0
        if hot.any():
            out.append(large(rows[0][hot], rows[1][hot], 1))
            rows = rows[:, ~hot]
        if open_large is not None and rows.shape[1]:
            more = rows[0] == open_large
            out.append(large(rows[0][more], rows[1][more]))
            if not more.all():
                open_large = None
            rows = rows[:, ~more]
        if rows.shape[1]:
            # copies of a class from different tasks stand next to each other
            again = np.zeros(rows.shape[1], bool)
            again[1:] = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
            rows = rows[:, ~again]
            start = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
            size = np.diff(np.r_[start, rows.shape[1]])
            if not last:  # the last group may go on in the next batch
                if size[-1] > GROUP:
                    open_large = rows[0][-1]
                    rest = np.zeros((4, 0), np.int64)
                else:
                    rest = rows[:, start[-1]:]
                    start, size = start[:-1], size[:-1]
            else:
                rest = np.zeros((4, 0), np.int64)
            for m in np.unique(size[size > 1]):
                at = start[size == m]
                if m > GROUP:
                    every = (at[:, None] + np.arange(m)).ravel()
                    out.append(large(rows[0][every], rows[1][every]))
                    continue
                x, y = np.triu_indices(m, 1)
                step = max(1, (1 << 20) // len(x))
                for k in range(0, len(at), step):
                    i, j = (at[k:k + step, None] + x).ravel(), (at[k:k + step, None] + y).ravel()
                    na, nb = rows[2][i], rows[2][j]
                    fit = 100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)
                    i, j = i[fit], j[fit]
                    swap = rows[1][i] > rows[1][j]
                    i, j = np.where(swap, j, i), np.where(swap, i, j)
                    out.append(np.stack([rows[1][i], rows[1][j], rows[2][i], rows[2][j], rows[3][i], rows[3][j]]))
        for part in out:
            if part.shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(part, _MET)], schema=_MET)

    for batch in batches:
        rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
        yield from work(np.concatenate([rest, rows], axis=1), False)
    yield from work(rest, True)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, tokens) of the classes in `wanted` (key, rep), taken from their representative's text.

    A fixed-size filter of the representatives' ids spares the other texts; what
    it lets through beyond that is removed by the join with `wanted`.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(id_filter(wanted, "rep"))
    bit = filter_bit("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(in_filter(bits.value, batch.column(2)))
            for block in blocks([batch.select([0, 1])], "text"):
                sets = sets_of(block.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([class_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["key", "tokens"])

    return docs.select("doc_id", "text", bit.alias("bit")).mapInArrow(run, "key bigint, tokens binary").filter("octet_length(tokens) > 0")


def _numbers(column: pa.Array, kind=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _meet_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, na, nb, fa, fb, ea, eb) with prefixes of the second order, the pairs that meet there under the bound."""
    for batch in batches:
        na, nb, ea, eb = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3, 6, 7))
        common = np.array([np.isin(x, y).sum() for x, y in zip(_numbers(batch.column(4), np.uint32), _numbers(batch.column(5), np.uint32))], np.int64)
        keep = (common > 0) & (most_overlap(common, na, nb, ea, eb) >= least_overlap(na, nb))
        yield batch.select([0, 1]).filter(pa.array(keep))


def _prefixes(sets: DataFrame, frequent) -> DataFrame:
    """(key, first, end): each set's prefix in the second order, as 32-bit numbers (equal shingles stay
    equal, so chance equalities only let more pairs through to the verification)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [ordered(t, frequent.value, SEEDS[1])[:prefix_length(len(t))] for t in _numbers(batch.column(1))]
            end = np.array([order_value(f[-1:], frequent.value, SEEDS[1])[0] for f in first], np.int32)
            short = [(f >> np.uint64(16)).astype(np.uint32).tobytes() for f in first]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary()), pa.array(end)], names=["key", "first", "end"])
    return sets.mapInArrow(run, "key bigint, first binary, end int")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [linked(x, y) for x, y in zip(_numbers(batch.column(2)), _numbers(batch.column(3)))]
        yield batch.select([0, 1]).filter(pa.array(np.array(keep, bool)))


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    left = sets.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(_verify, "a bigint, b bigint")


def _search(key: tuple, queries: pa.Table, members: pa.Table) -> pa.Table:
    """Links between a block of queries and a block of the members of their cluster."""
    qk, qs = queries.column("q_key").to_numpy(), _numbers(queries.column("q_tokens").combine_chunks())
    mk, ms = members.column("key").to_numpy(), _numbers(members.column("tokens").combine_chunks())
    if not len(qk) or not len(mk):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    shared = np.intersect1d(np.concatenate(qs), np.concatenate(ms))
    common = np.zeros((len(qk), len(mk)), np.int32)
    for k in range(0, len(shared), 4096):  # so many shingles at a time
        part = shared[k:k + 4096]

        def rows(sets):
            out = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                out[i, np.searchsorted(part, s[np.isin(s, part, assume_unique=True)])] = 1
            return out

        common += (rows(qs) @ rows(ms).T).astype(np.int32)
    sizes = np.array([len(s) for s in qs])[:, None] + np.array([len(s) for s in ms])[None, :]
    i, j = np.nonzero(100 * common >= PERCENT * (sizes - common))
    differ = qk[i] != mk[j]
    return pa.table({"a": pa.array(qk[i][differ]), "b": pa.array(mk[j][differ])})


def _cluster_links(large: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among classes that share shingles of large groups (`large`: token, key), enough of them
    for the components to be right together with `links`."""
    spark = large.sparkSession
    pivots = large.groupBy("token").agg(*[F.min(F.struct(F.xxhash64("key", F.lit(r)).alias("h"), "key"))["key"].alias(f"p{r}")
                                          for r in range(PIVOTS)])
    own = large.groupBy("key").agg(F.min(F.struct(F.xxhash64("token", "key").alias("h"), "token"))["token"].alias("token"))  # spread over tokens
    star = (own.join(pivots, "token").select("key", F.explode(F.array(*[f"p{r}" for r in range(PIVOTS)])).alias("pivot"))
            .filter("key <> pivot").select(F.greatest("key", "pivot").alias("a"), F.least("key", "pivot").alias("b")).distinct())
    found = staged(_links(star, sets), "star-links")
    together = staged(components(links.unionByName(found)), "star-components").withColumnRenamed("node", "key")
    clusters = components(large.select(F.col("key").alias("a"), F.col("token").alias("b")))
    members = staged(large.select("key").distinct().join(clusters.withColumnsRenamed({"node": "key", "label": "cluster"}), "key")
                     .join(together, "key", "left").select("key", "cluster", F.coalesce("label", "key").alias("label")), "members")
    sizes = members.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    chief = sizes.groupBy("cluster").agg(F.max(F.struct("n", "label"))["label"].alias("chief"), F.sum("n").alias("n_members"),
                                         (F.sum("n") - F.max("n")).alias("n_queries")).filter("n_queries > 0")
    parts = lambda n: F.ceil(F.col(n) / SEARCH_BLOCK).cast("int")
    part = lambda n: F.pmod(F.xxhash64("key"), parts(n)).cast("int")
    at = members.join(chief, "cluster")
    every = lambda n: F.explode(F.sequence(F.lit(0), parts(n) - 1))
    queries = (at.filter("label <> chief").select("key", "cluster", part("n_queries").alias("qb"), every("n_members").alias("mb"))
               .join(sets, "key"))
    rows = at.select("key", "cluster", part("n_members").alias("mb"), every("n_queries").alias("qb")).join(sets, "key")
    block, fields = ["cluster", "qb", "mb"], ["key", "tokens"]
    queries = queries.select(*[F.col(c).alias(f"q_{c}") for c in block + fields])
    more = (queries.groupBy(*[f"q_{c}" for c in block]).cogroup(rows.select(*block, *fields).groupBy(*block))
            .applyInArrow(_search, "a bigint, b bigint"))
    return found.unionByName(more)


def _first_order(docs: DataFrame, frequent) -> DataFrame:
    """Pairs (a, b, na, nb) that meet in the first order under the bound, and the rows of `_meet` for frequent shingles."""
    salt = F.when(F.col("n") < 0, F.pmod("key", F.lit(1 << 20))).otherwise(F.lit(0))
    postings = docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text").mapInArrow(
        _postings(frequent), "token bigint, key bigint, n int, end int")
    met = (postings.repartition(shuffle_width(docs.sparkSession), "token", salt).sortWithinPartitions("token", "key")
           .mapInArrow(_meet, "a bigint, b bigint, na int, nb int, ea int, eb int"))
    rest = lambda n: F.expr(f"ceil({PERCENT} * {n} / 100) - 1")  # noqa: E731  behind the prefix
    bound = F.col("c") + F.when(F.col("ea") < F.col("eb"), rest("na")).when(F.col("eb") < F.col("ea"), rest("nb")).otherwise(F.greatest(rest("na"), rest("nb")))
    return (met.groupBy("a", "b", "na", "nb", "ea", "eb").agg(F.count(F.lit(1)).alias("c"))
            .filter((F.col("na") == 0) | (bound * (100 + PERCENT) >= PERCENT * (F.col("na") + F.col("nb"))))
            .select("a", "b", "na", "nb"))


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, key, n) per row of `docs`, th being the hash of its text and key its class, and
    (key, rep, label) per class: its smallest doc_id and its component."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    survey = staged(docs.withColumn("th", F.xxhash64("text")).mapInArrow(_survey, "doc_id bigint, th bigint, key bigint, n bigint"), "survey")
    rows = survey.filter("n >= 0")
    classes = rows.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"))
    found = (survey.filter("n < 0").groupBy(F.col("key").alias("token")).agg(F.sum("n").alias("n")).filter(f"n <= -{FREQUENT}"))
    known = np.zeros(0, np.uint64)
    for _ in range(PASSES):
        counted = found.orderBy("n", "token").limit(MOST_FREQUENT - len(known)).select("token").collect()  # bounded; it only shapes the order
        if not counted and len(known):
            break
        known = np.union1d(known, np.array([r[0] for r in counted], np.int64).view(np.uint64))
        frequent = spark.sparkContext.broadcast(known)
        first = staged(_first_order(docs, frequent), "met")
        release(spark)
        found = first.filter("na = 0 AND nb = 0").groupBy(F.col("a").alias("token")).agg((-F.count(F.lit(1))).alias("n"))
        complete = found.isEmpty()
        if len(known) >= MOST_FREQUENT or complete:
            break
    pairs = first.filter("na > 0")
    large = first.filter("na = 0").select(F.col("a").alias("token"), F.col("b").alias("key"))
    several = large.groupBy("token").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo <> hi").select("token")
    if complete:  # only shingles of the bounded list are left
        several = F.broadcast(several)
    large = staged(large.join(several, "token").distinct(), "large")

    wanted = (pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
              .unionByName(large.select("key")).distinct())
    sets = staged(_sets(docs, wanted.join(classes, "key")).dropDuplicates(["key"]), "sets")
    heads = _prefixes(sets, frequent)
    left = heads.select(F.col("key").alias("a"), F.col("first").alias("fa"), F.col("end").alias("ea"))
    right = heads.select(F.col("key").alias("b"), F.col("first").alias("fb"), F.col("end").alias("eb"))
    second = staged(pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "fa", "fb", "ea", "eb")
                    .mapInArrow(_meet_again, "a bigint, b bigint"), "met-twice")
    release(spark)
    links = staged(_links(second, sets), "links")
    release(spark)
    if not large.isEmpty():
        links = staged(links.unionByName(_cluster_links(large, links, sets)), "links")
    labels = components(links).withColumnsRenamed({"node": "key"})
    placed = classes.join(labels, "key", "left").select("key", "rep", F.coalesce("label", "key").alias("label"))
    return rows, placed


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id per row of `docs`."""
    rows, placed = _placed(docs)
    ids = placed.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = placed.join(ids, "label").select("key", "component_id")
    joined = rows.join(of, "key", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay: of each component the one with the smallest (doc_id, hash of the text),
    null ids last, once (of rows with that id and text the one with the smallest hash of all columns).
    Rows whose text has no word are linked with nothing and all stay."""
    rows, placed = _placed(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th"))
    heads = (rows.filter("n > 0").groupBy("key").agg(least.alias("head")).join(placed.select("key", "label"), "key")
             .groupBy("label").agg(F.min("head").alias("head"))
             .select(F.xxhash64("head.doc_id", "head.th").alias("at"), F.col("head.th").alias("th")))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                        F.xxhash64("text").alias("th"), F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    once = (named.filter("worded").select("row", F.xxhash64("id", "th").alias("at"), "th")
            .groupBy("at", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row")))  # repeats meet in their own tasks first
    kept = once.join(heads, ["at", "th"], "left_semi").select("row").unionByName(named.filter("worded IS NOT TRUE").select("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
