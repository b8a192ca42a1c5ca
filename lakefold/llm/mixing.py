"""Mixing sources to target weights by entropy balancing (SQL functions only).

Targets: the sources, by code point and null last, weigh 5, 2, 1, repeating;
they share 150 % of all words; a target stops at twice its source's words and
the excess goes to the others by weight.

Rates: of all document rates that meet the targets, the ones nearest to 1 in
relative entropy (weighted by words) are exponentially tilted, rate = exp(l_s).
The dual is convex; Newton steps l_s += (T_s - M_s) / M_s, with M_s the words
that the present rates take, solve it.  Each step is a distributed sum.

Copies: documents of a source are dealt to blocks of about BLOCK rows by a hash
of their id, text and number among equal rows, and within a block, by size, copies are the whole-number steps of
the running sum of rates.  What a source then lacks or has too much is mended
with single documents of its first block, largest first; if the gap is too large
for one block, all blocks of the source give their part in proportion first.

A size is the number of `[^\\x20\\x09-\\x0D]+` in the text.  Defined results: a
null or empty text has size 0 and adds nothing; null is a source of its own; a
null id is kept; rows that repeat, or share an id, are documents of their own
(equal rows are counted and counted out again, so they need no common task); without any word all targets are
0; an empty table gives an empty mix; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakefold.llm.common import ranked, staged
from lakefold.operators.hot_groups import explode_range

WEIGHTS = (5, 2, 1)
SHARE = 1.5    # of all words, for the whole mix
MOST = 2       # times a source's or a document's own size
ROW = ("doc_id", "th", "nth")  # what tells rows of a source apart
BLOCK = 512    # documents in a rounding block, on average
STEPS = 60     # Newton steps at most; a step is quadratic near the solution
TOLERANCE = 1e-12


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+`; null: 0."""
    spaced = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     "))
    return F.when(spaced == "", F.lit(0)).otherwise(F.size(F.split(spaced, " +"))).cast("bigint")


def targets(sources: DataFrame) -> DataFrame:
    """`sources` (source, source_size) with `target`."""
    n = len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("pos") % n + 1).cast("int"))
    weighted = staged(ranked(sources.select("source", "source_size"), "source").withColumn("weight", weight).drop("pos"),
                      "weights")
    cap = F.col("source_size") * float(MOST)
    sums = weighted.agg((F.sum("source_size") * SHARE).alias("all"), F.sum("weight").alias("weight")).first()
    total, unit, n_capped = sums["all"] or 0.0, (sums["all"] or 0.0) / (sums["weight"] or 1.0), 0
    while True:  # each turn caps a source more, or ends; only sums come to the driver
        over = F.col("weight") * unit >= cap
        s = weighted.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, cap).otherwise(0.0)).alias("fixed"),
                         F.sum(F.when(~over, F.col("weight")).otherwise(0.0)).alias("weight")).first()
        if s["n"] == n_capped or not s["weight"]:
            break
        n_capped, unit = s["n"], (total - s["fixed"]) / s["weight"]
    return weighted.select("source", "source_size", F.least(F.col("weight") * unit, cap).alias("target"))


def balance(goals: DataFrame) -> DataFrame:
    """`goals` (source, source_size, target) with `rate`: the solution of the entropy balancing dual."""
    open_ = (F.col("source_size") > 0) & (F.col("target") > 0)
    state = staged(goals.withColumn("tilt", F.when(open_, F.lit(0.0))), "tilt")
    mass = F.col("source_size") * F.exp("tilt")
    for _ in range(STEPS):
        gap = state.agg(F.max(F.abs(mass - F.col("target")) / F.col("target"))).first()[0]
        if gap is None or gap <= TOLERANCE:
            break
        state = staged(state.withColumn("tilt", F.col("tilt") + (F.col("target") - mass) / F.greatest(mass, F.col("target") / 2)), "tilt")
    return state.select("source", "source_size", "target", F.coalesce(F.exp("tilt"), F.lit(0.0)).alias("rate"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), nth (number among equal rows), source, size, source_size, target, rate, copies,
    taken per row of `docs`."""
    equal = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("th"))
             .groupBy("doc_id", "source", "size", "th").agg(F.count(F.lit(1)).alias("n")))
    sized = staged(explode_range(equal, F.col("n"), "nth").drop("n"), "sizes")
    sources = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")),
                     "sources")
    rates = balance(targets(sources)).withColumnRenamed("source", "_s")
    plan = rates.join(sources.select(F.col("source").alias("_t"), "n_docs"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    block = F.pmod(F.xxhash64(*ROW), F.ceil(F.col("n_docs") / BLOCK))
    joined = (sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("block", block))
    upto = W.partitionBy("source", "block").orderBy("size", *ROW).rowsBetween(W.unboundedPreceding, 0)
    start = F.pmod(F.xxhash64("source", "block"), F.lit(1000)) / 1000.0
    run = start + F.sum("rate").over(upto)
    drawn = staged(joined.withColumn("run", run).withColumn(
        "copies", F.least(F.lit(MOST), F.floor("run") - F.floor(F.col("run") - F.col("rate"))).cast("bigint")).drop("run"),
        "drawn")
    return _mended(drawn).withColumn("taken", F.col("copies") * F.col("size"))


def _lack(drawn: DataFrame) -> DataFrame:
    """The words that each source (`_s`) lacks."""
    return (drawn.groupBy("source").agg(F.round(F.max("target") - F.sum(F.col("copies") * F.col("size"))).cast("bigint").alias("lack"))
            .withColumnRenamed("source", "_s"))


def _moved(drawn: DataFrame, wanted: DataFrame) -> DataFrame:
    """`drawn` after single documents went up or down by one copy, largest first, as long as they fit into
    what a block of a source (`_s`, `_b`) is to give (`part`, with its sign)."""
    here = F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))
    pool = (drawn.join(wanted, here).filter(F.col("size") > 0).groupBy("source", "block")
            .agg(F.first("part").alias("part"), F.sort_array(F.collect_list(F.struct("size", *ROW, "copies")), False).alias("pool")))
    picks = pool.select("source", "block", F.signum("part").cast("bigint").alias("by"), F.expr(f"""
        aggregate(filter(pool, p -> IF(part > 0, p.copies < {MOST}, p.copies > 0)),
          named_struct('left', abs(part), 'ids', CAST(array() AS ARRAY<STRUCT<doc_id: BIGINT, th: BIGINT, nth: BIGINT>>)),
          (a, p) -> IF(p.size <= a.left, named_struct('left', a.left - p.size, 'ids', array_append(a.ids,
                       named_struct('doc_id', p.doc_id, 'th', p.th, 'nth', p.nth))), a),
          a -> a.ids)""").alias("ids"))
    moves = picks.select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.explode("ids").alias("_d"), "by")
    same = F.col("doc_id").eqNullSafe(F.col("_d.doc_id")) & (F.col("th") == F.col("_d.th")) & (F.col("nth") == F.col("_d.nth"))
    return (drawn.join(moves, same & here, "left")
            .withColumn("copies", F.col("copies") + F.coalesce("by", F.lit(0))).drop("_s", "_b", "_d", "by"))


def _shares(drawn: DataFrame, in_turn: bool) -> DataFrame:
    """What the blocks of a source but the first are to give (`_s`, `_b`, `part`), where half of the first block's
    documents cannot close its gap: the excess, in proportion to the documents that may move and fit, or (`in_turn`)
    all of them block by block, up to the excess."""
    lack = _lack(drawn)
    movable = (F.col("size") > 0) & (F.col("size") <= F.abs("lack")) & F.when(F.col("lack") > 0, F.col("copies") < MOST).otherwise(F.col("copies") > 0)
    rooms = (drawn.join(lack, F.col("source").eqNullSafe(F.col("_s"))).filter(movable)
             .groupBy("_s", F.col("block").alias("_b")).agg(F.sum("size").alias("room"), F.first("lack").alias("lack")))
    all_ = rooms.groupBy(F.col("_s").alias("_t")).agg(F.sum(F.when(F.col("_b") == 0, F.col("room")).otherwise(0)).alias("own"),
                                                      F.sum(F.when(F.col("_b") != 0, F.col("room")).otherwise(0)).alias("others"))
    excess = F.abs("lack") - F.col("own") / 2
    if in_turn:
        earlier = F.coalesce(F.sum("room").over(W.partitionBy("_s").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each block
        part = F.greatest(F.least(F.floor(excess) - earlier, F.col("room")), F.lit(0)).cast("bigint")
    else:
        part = F.floor(F.least(excess / F.col("others"), F.lit(1.0)) * F.col("room")).cast("bigint")
    return (rooms.join(all_, F.col("_s").eqNullSafe(F.col("_t"))).filter((F.col("_b") != 0) & (excess > 0))
            .withColumn("part", part).select("_s", "_b", (F.col("part") * F.signum("lack").cast("bigint")).alias("part")).filter("part <> 0"))


def _mended(drawn: DataFrame) -> DataFrame:
    """Move single documents of each source up or down by one copy, until the gap is smaller than any of them: in
    block 0, and before that in the other blocks, if the gap is too large for one block."""
    for in_turn in (False, True):  # what is less than a document in each block is left for the second
        shares = staged(_shares(drawn, in_turn), "shares")
        if shares.isEmpty():
            break
        drawn = staged(_moved(drawn, shares), "drawn")
    last = _lack(drawn).select("_s", F.lit(0).cast("bigint").alias("_b"), F.col("lack").alias("part"))
    return _moved(drawn, last).drop("block", "n_docs")


def mix_report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` as the mix takes them: none, one or two copies of each.  Rows with equal
    id and text are taken alike, as often as the one that is taken most."""
    chosen = mix(docs).groupBy("doc_id", "th").agg(F.max("copies").alias("copies")).filter("copies > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))
    taken = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    return (taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
