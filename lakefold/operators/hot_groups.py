"""Bounded groups: split any key group into parts of about ``max_rows`` rows.

A nested document (an invoice with its items, a project with its tasks, a log
page with its rows) is built by collecting a group.  One key may hold a large
share of all rows, and so may one row repeated many times, so a group is never
collected whole:

1. exact copies are first collapsed to (row, copies) by an aggregate whose
   map-side combine absorbs any hot row;
2. each key gets ``ceil(rows / max_rows)`` parts (the per-key count is another
   combined aggregate; it joins back on the key, where AQE splits a skewed key);
3. a distinct row's copies are cut into chunks of at most ``max_rows`` and each
   chunk gets a part: a hash of the whole row, plus the chunk number;
4. chunks are dealt out by key and part, and only there expanded to copies.

Every step is deterministic: a retried task recomputes the same parts.

These steps move every row several times.  Where few keys are that large, they are for
those alone: ``hot_keys`` finds them with a combined count, and ``attach_groups`` moves
the rows of all other keys once, to their parent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.functions.keys import hash32
from lakefold.session import brief_shuffles, fresh_path

RANGE_BLOCK = 4096


def document_of(doc_id: str = "doc_id") -> Column:
    """The document a row of documents belongs to: a large document is stored as
    several rows, whose ids are its own id, ``#`` and a part number."""
    return F.substring_index(F.col(doc_id), "#", 1)


def part_of(doc_id: str = "doc_id") -> Column:
    return F.when(F.col(doc_id).contains("#"), F.substring_index(F.col(doc_id), "#", -1)).otherwise(F.lit("0"))


def explode_range(df: DataFrame, n: Column, name: str) -> DataFrame:
    """A row for each number 0 .. n - 1 in ``name``, made in blocks, so that no row
    ever holds more than ``RANGE_BLOCK`` numbers."""
    blocks = df.withColumn("_end", n.cast("bigint")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil((F.col("_end") - 1) / RANGE_BLOCK).cast("bigint"))))
    blocks = blocks.where(F.col("_block") * RANGE_BLOCK < F.col("_end"))
    first = F.col("_block") * RANGE_BLOCK
    last = F.least(first + RANGE_BLOCK, F.col("_end")) - 1
    return blocks.withColumn(name, F.explode(F.sequence(first, last))).drop("_end", "_block")


def split_hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int, part_col: str = "part") -> DataFrame:
    """Add ``part_col`` so that each (keys, part) group has about ``max_rows`` rows.

    Returns the same rows (with multiplicity, rows with a null key included)
    plus ``part_col`` and ``{part_col}_count`` (the key's number of parts),
    dealt out by key and part.
    """
    cols = df.columns
    copies = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = (copies.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("_copies").alias("_group_rows")))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    n_parts = F.greatest(F.lit(1), F.ceil(F.col("_group_rows") / F.lit(max_rows))).cast("bigint")
    sized = copies.join(per_key, same).select(*cols, "_copies", n_parts.alias("_n_parts"))
    chunks = explode_range(sized, F.ceil(F.col("_copies") / F.lit(max_rows)), "_chunk")
    row = F.sha2(F.to_json(F.struct(*cols)), 256)
    chunk_rows = F.least(F.lit(max_rows).cast("bigint"), F.col("_copies") - F.col("_chunk") * max_rows)
    dealt = chunks.select(*cols, F.pmod(hash32(row) + F.col("_chunk"), F.col("_n_parts")).alias(part_col),
                          F.col("_n_parts").alias(f"{part_col}_count"), chunk_rows.cast("int").alias("_rows"))
    return (dealt.repartition(*keys, part_col)
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(True), F.col("_rows")))).drop("_copy", "_rows"))


def attach_parts(parents: DataFrame, parent_key: str, parts: DataFrame, part_key: str,
                 part_col: str = "part") -> DataFrame:
    """Each parent with each of its parts, and a parent without parts once
    (part columns NULL): a left outer join of parents to their parts, made of
    joins that are one-to-one, so no key can be skewed.

    ``parts`` has one row per (``part_key``, ``part_col``) and a
    ``{part_col}_count`` column (see ``split_hot_groups``).  Each parent is
    expanded to its candidate part numbers (from a one-row-per-key count) and
    matched on (key, part); candidates of a parent that has parts but no rows
    in that part are dropped.  The bulky part rows are never re-shuffled by the
    parent key alone, where a parent with many parts would land in one task.
    """
    count_col = f"{part_col}_count"
    n = parts.groupBy(F.col(part_key).alias("_pk")).agg(F.max(count_col).alias("_n"))
    known = parents.join(n, parents[parent_key] == n["_pk"], "left").select(*[parents[c] for c in parents.columns], "_n")
    cand = explode_range(known, F.coalesce(F.col("_n"), F.lit(1)), "_cand")
    # Fresh names on the part side: both join inputs derive from ``parts``.
    body = parts.select(*[F.col(c).alias(f"_b_{c}") for c in parts.columns if c != count_col])
    joined = cand.join(body, (F.col(parent_key) == F.col(f"_b_{part_key}")) & (F.col("_cand") == F.col(f"_b_{part_col}")),
                       "left")
    kept = joined.where(F.col(f"_b_{part_col}").isNotNull() | F.col("_n").isNull())
    return kept.select(*parents.columns, *[F.col(f"_b_{c}").alias(c) for c in parts.columns if c != count_col])


FEW_KEYS = 1 << 16  # a table of so many keys is sent to every task


def hot_keys(df: DataFrame, key: str, max_rows: int) -> DataFrame | None:
    """The keys of more than ``max_rows`` rows, as a written table; None if there is none.

    There is at most one for each ``max_rows`` rows.  A few are broadcast where they are
    joined; a longer list is joined as any table is.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "hot-keys")
    with brief_shuffles(spark):
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > max_rows) & F.col(key).isNotNull()).select(key).write.parquet(path)
    found = spark.read.parquet(path)
    n = found.count()
    return None if n == 0 else F.broadcast(found) if n <= FEW_KEYS else found


def attach_groups(parents: DataFrame, parent_key: str, rows: DataFrame, key: str, item: Column, name: str,
                  max_rows: int, hot: DataFrame | None, part_col: str = "part") -> DataFrame:
    """Each parent with the sorted array ``name`` of its rows (``item`` of each), NULL if it has none.

    A parent of a ``hot`` key (see ``hot_keys``) comes once for each part of its rows, numbered in
    ``part_col``, any other once, with part 0.  Rows without a parent are in no array.
    """
    def arrays(df: DataFrame, *by: str, **more: Column) -> DataFrame:
        # items come from a projection, in compiled code: an aggregate's own input is interpreted row by row
        made = df.select(*by, *more, item.alias("_item"))
        return made.groupBy(*by).agg(F.array_sort(F.collect_list("_item")).alias(name), *[c.alias(n) for n, c in more.items()])

    few, few_parents = (rows, parents) if hot is None else (
        rows.join(hot, key, "left_anti"), parents.join(hot, parents[parent_key] == hot[key], "left_anti"))
    small = arrays(few.where(F.col(key).isNotNull()).repartition(key), key).withColumnRenamed(key, f"_b_{key}")
    out = few_parents.join(small, F.col(parent_key) == F.col(f"_b_{key}"), "left").select(
        *few_parents.columns, F.lit(0).cast("bigint").alias(part_col), name)
    if hot is None:
        return out
    split = split_hot_groups(rows.join(hot, key, "left_semi"), [key], max_rows, part_col)
    count_col = f"{part_col}_count"
    parts = arrays(split, key, part_col, **{count_col: F.max(count_col)})
    many = attach_parts(parents.join(hot, parents[parent_key] == hot[key], "left_semi"), parent_key, parts, key, part_col)
    return out.unionByName(many.select(*parents.columns, F.coalesce(F.col(part_col), F.lit(0).cast("bigint")).alias(part_col), name))
