"""Entropy balancing of several families of token constraints at once (SQL functions only).

Rows bear a size and a category in each family, such as source and language;
every category has a target of words.  Of all rates that meet the targets, those
nearest to 1 in relative entropy are exp(sum of the tilts of the row's categories).
The dual, sum of size * exp(tilts) - sum of tilt * target, is convex.  Its gradient and
Hessian are sums over rows: one grouping to combinations of categories, and then, in
each Newton step, one sum for every pair of categories that meet in a combination.
The driver holds MOST constraints at the most and solves for their step; a step is
halved until the dual falls.  Families overlap in their total, so the Hessian is
singular in those directions, which the least-squares solution leaves alone.

Defined results: targets of the later families are scaled to the total of the
first; a category without words or without a target row takes no part (rows whose
category has no target row have rate 0, as those of target 0); null is a category;
rows of size 0 or null count for nothing; an empty table gives an empty result.  If
no rates meet all targets, the steps end and `gap` tells by how much the worst is missed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakefold.llm.common import staged

MOST = 1024          # constraints in all; the driver solves a system of this size
STEPS = 50
TOLERANCE = 1e-10
HALVINGS = 30


def _constraints(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(family, category, target, k) of the categories that have words and a target; k numbers them."""
    out = None
    for family, goals in targets.items():
        held = cells.select(F.col(family).cast("string").alias("held")).distinct()
        own = (goals.select(F.lit(family).alias("family"), F.col(family).cast("string").alias("category"), F.col("target").cast("double"))
               .filter("target > 0").join(held, F.col("category").eqNullSafe(F.col("held")), "left_semi"))
        out = own if out is None else out.unionByName(own)
    number = F.row_number().over(W.orderBy("family", "category")) - 1  # few rows
    return out.withColumn("k", number)


def _tilt(tilts: np.ndarray) -> Column:
    return F.aggregate("ks", F.lit(0.0), lambda total, k: total + F.get(F.lit(tilts), k))


def _moments(cells: DataFrame, tilts: np.ndarray) -> np.ndarray:
    """The Hessian of the dual; its diagonal is the words that the rates take of each category."""
    pairs = F.flatten(F.transform("ks", lambda k: F.transform("ks", lambda l: F.struct(k.alias("k"), l.alias("l")))))
    sums = (cells.select((F.col("size") * F.exp(_tilt(tilts))).alias("mass"), F.explode(pairs).alias("p"))
            .groupBy("p.k", "p.l").agg(F.sum("mass").alias("mass")).collect())  # at most MOST * MOST numbers
    out = np.zeros((len(tilts), len(tilts)))
    for k, l, mass in sums:
        out[k, l] = mass
    return out


def _dual(cells: DataFrame, candidates: list[np.ndarray], goal: np.ndarray) -> np.ndarray:
    """The dual at each of the candidates, in one pass."""
    row = cells.agg(*[F.sum(F.col("size") * F.exp(F.least(_tilt(t), F.lit(500.0)))) for t in candidates]).first()
    return np.array([value - t @ goal for value, t in zip(row, candidates)])


def balanced_rates(rows: DataFrame, size: str, targets: dict[str, DataFrame]) -> DataFrame:
    """Per combination of categories in `rows`: the family columns, size, rate and gap (the largest relative
    miss of any target).  `targets` has, for each family column, a table of its categories and `target`."""
    families = list(targets)
    cells = staged(rows.groupBy(*families).agg(F.sum(F.col(size).cast("double")).alias("size")), "balance-cells")
    known = staged(_constraints(cells.filter("size > 0"), targets), "balance-constraints")
    n = known.count()
    if n > MOST:
        raise ValueError(f"{n} constraints, {MOST} at the most")
    for family in families:
        own = F.broadcast(known.filter(F.col("family") == family).select("category", F.col("k").alias(f"_k_{family}")))  # MOST rows at the most
        cells = cells.join(own, F.col(family).cast("string").eqNullSafe(F.col("category")), "left").drop("category")
    ks = F.array(*[F.col(f"_k_{f}") for f in families])
    cells = staged(cells.select(*families, "size", F.when((F.col("size") > 0) & ~F.exists(ks, lambda k: k.isNull()), ks).alias("ks")), "balance-cells")
    goal, total, tilts, gap = np.zeros(n), {}, np.zeros(n), None
    listed = known.collect()
    for r in listed:
        total[r.family] = total.get(r.family, 0.0) + r.target
    for r in listed:
        goal[r.k] = r.target * total[families[0]] / total[r.family] if families[0] in total else 0.0
    used = cells.filter("ks IS NOT NULL")
    for _ in range(STEPS if n else 0):
        hessian = _moments(used, tilts)
        miss = goal - hessian.diagonal()
        gap = float(np.max(np.abs(miss) / goal))
        if gap <= TOLERANCE:
            break
        step = np.linalg.lstsq(hessian, miss, rcond=1e-12)[0]
        sizes = 0.5 ** np.arange(HALVINGS)
        values = _dual(used, [tilts, *(tilts + s * step for s in sizes)], goal)
        falls = np.flatnonzero(values[1:] <= values[0] - 1e-4 * sizes * (miss @ step))
        if not len(falls):
            if gap > 1e-6:
                break
            falls = [0]  # so near the solution that rounding hides the fall
        tilts = tilts + sizes[falls[0]] * step
    rate = F.when(F.col("ks").isNotNull(), F.exp(_tilt(tilts))).otherwise(F.lit(0.0)) if n else F.lit(0.0)
    return cells.select(*families, "size", rate.alias("rate"), F.lit(gap).cast("double").alias("gap"))
