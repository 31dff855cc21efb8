"""Classification trees with exact thresholds, many of them grown together, level by level.

Rows carry ``tree``, ``id``, ``x`` (array of doubles, NULL entries lowest and always left), ``y`` (0 or 1) and ``n``, the copies of the
row in the bag of its tree; a row with ``n = 0`` trains nothing and only travels down, to be scored. A level is one aggregation for all
trees: rows are counted per (tree, node, feature, value) with map-side partial results, counts are summed up in order of the values,
and the best cut of each node goes back to its rows. Cuts lie half way between neighbouring values of the node, there is no limit of
depth, and ties go to the first feature and the smallest cut.

No node is held in one task: running counts are taken inside coarse bins of each feature (``BINS``, from one approximate scan), and
over the bins. The bins share out work only; trees are the same for any number of them. Splits are joined back by key, with hot nodes
salted, and every level is checkpointed. Trees are tables, of which nothing but the bins' borders reaches the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import exp, factorial, inf, isfinite, isqrt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.functions.scalars import literal_matrix
from ledgerlark.operators.skew import attach_by_key
from ledgerlark.session import cut_lineage, rewritten

#: Coarse bins per feature.
BINS = 256
_PATH = "array<struct<rows:bigint,p:double>>"


@dataclass(frozen=True)
class Grown:
    """``nodes``: tree, node (its turns from the root, 0 is left), depth, rows, n0 and n1 (copies per class), weight, p (share of class 1),
    feature, threshold and gain (all NULL in leaves). ``landed``: travelling rows with the rows and p of each node on their path."""

    nodes: DataFrame
    landed: DataFrame


def bagged(id_col: str, tree: str, seed: int = 42) -> Column:
    """Copies of a row in the bag of a tree: a Poisson(1) draw that depends on seed, tree and id only."""
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(tree), F.col(id_col)), F.lit(1 << 53)) / float(1 << 53)
    below, steps = 0.0, []
    for k in range(18):
        below += exp(-1) / factorial(k)
        steps.append((at >= below).cast("long"))
    return reduce(lambda a, b: a + b, steps)


def grow(
    rows: DataFrame,
    features: int,
    max_depth: int | None = None,
    min_split: int = 2,
    min_leaf: int = 1,
    balanced: bool = False,
    draw: int | None = None,
    seed: int = 42,
    bins: int = BINS,
) -> Grown:
    """Grow the trees of all rows by Gini impurity.

    A node is split if it holds both classes, at least ``min_split`` rows and lies above ``max_depth``; both parts keep ``min_leaf``
    rows. ``draw`` features are tried per node, in an order hashed from seed, tree and node, and more only while none can be cut.
    ``balanced`` weighs classes alike in each tree. An empty table gives no nodes.
    """
    binned = _with_bins(rows.where(F.col("n") > 0), rows, features, bins)
    active = binned.select(
        "tree", "id", "y", "n", "x", F.lit("").alias("node"), F.array().cast(_PATH).alias("path")
    )
    active = cut_lineage(active)
    weights = cut_lineage(_class_weights(active)) if balanced else None
    nodes, landed = [], []
    while True:
        cuts = _cuts(active, weights, min_leaf)
        best = _best(cuts, features if draw is None else draw, features, seed, min_split, max_depth)
        best = rewritten(best, "nodes")
        moved = attach_by_key(active, best.select("tree", "node", "rows", "p", "feature", "threshold"), ["tree", "node"], "rows")
        step = F.struct("rows", "p").cast("struct<rows:bigint,p:double>")
        moved = rewritten(moved.withColumn("path", F.when(F.col("n") == 0, F.concat("path", F.array(step))).otherwise(F.col("path"))), "rows")
        nodes.append(best)
        landed.append(moved.where(F.col("feature").isNull() & (F.col("n") == 0)).select("tree", "id", "y", "node", "path"))
        if best.where(F.col("feature").isNotNull()).isEmpty():
            break
        turn = F.when(F.expr("x[feature].v <= threshold"), "0").otherwise("1")
        active = moved.where(F.col("feature").isNotNull()).withColumn("node", F.concat("node", turn)).select(*active.columns)
    return Grown(reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, landed))


def _with_bins(train: DataFrame, rows: DataFrame, features: int, bins: int) -> DataFrame:
    """``x`` as (value, coarse bin) per feature."""
    shares = [i / bins for i in range(1, bins)]
    cells = train.select(F.posexplode("x").alias("f", "v"))
    found = cells.groupBy("f").agg(F.percentile_approx("v", shares, 4 * bins).alias("b")).collect() if shares else []
    by = {r["f"]: sorted({b for b in r["b"] or [] if isfinite(b)}) for r in found}
    borders = literal_matrix([[float(v) for v in by.get(f, [])] or [sys.float_info.max] for f in range(features)])

    def cell(v: Column, f: Column) -> Column:
        known = F.coalesce(v, F.lit(-inf))
        return F.struct(known.alias("v"), F.size(F.filter(F.get(borders, f), lambda b: b < known)).alias("b"))

    return rows.withColumn("x", F.transform("x", cell))


def _class_weights(active: DataFrame) -> DataFrame:
    """Rows (tree, w0, w1), as many as there are trees."""
    n, n1 = F.sum("n"), F.sum(F.col("n") * F.col("y"))
    sizes = active.groupBy("tree").agg(n.alias("n"), n1.alias("n1"))
    weight = [F.coalesce(F.try_divide(F.col("n").cast("double"), 2 * c), F.lit(0.0)) for c in (F.col("n") - F.col("n1"), F.col("n1"))]
    return sizes.select("tree", weight[0].alias("w0"), weight[1].alias("w1"))


def _cuts(active: DataFrame, weights: DataFrame | None, min_leaf: int) -> DataFrame:
    """Every cut between two neighbouring values of a node, with the sums left of it and of the whole node."""
    key = ["tree", "node", "feature"]
    cells = active.where(F.col("n") > 0).select("tree", "node", "y", "n", F.posexplode("x").alias("feature", "c"))
    cells = cells.groupBy(*key, F.col("c.b").alias("bin"), F.col("c.v").alias("value")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("n") * (1 - F.col("y"))).alias("n0"),
        F.sum(F.col("n") * F.col("y")).alias("n1"),
    )
    sums = ["rows", "n0", "n1"]
    over = W.partitionBy(*key)
    before = over.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    by_bin = cells.groupBy(*key, "bin").agg(F.min("value").alias("first"), *[F.sum(s).alias(f"b_{s}") for s in sums])
    by_bin = by_bin.select(
        *key,
        "bin",
        F.lead("first").over(over.orderBy("bin")).alias("_next"),
        *[F.coalesce(F.sum(f"b_{s}").over(before), F.lit(0)).alias(f"before_{s}") for s in sums],
        *[F.sum(f"b_{s}").over(over).alias(f"all_{s}") for s in sums],
    )
    inside = W.partitionBy(*key, "bin").orderBy("value")
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    run = cells.select(
        *key, "bin", "value", F.lead("value").over(inside).alias("_lead"), *[F.sum(s).over(upto).alias(s) for s in sums]
    )
    cuts = run.join(by_bin, [*key, "bin"])
    cuts = cuts.withColumns({s: F.col(s) + F.col(f"before_{s}") for s in sums})
    cuts = cuts.withColumn("_next", F.coalesce("_lead", "_next"))
    if weights is None:
        cuts = cuts.withColumns({"w0": F.lit(1.0), "w1": F.lit(1.0)})
    else:
        cuts = cuts.join(F.broadcast(weights), "tree")
    left = F.col("n0") * F.col("w0") + F.col("n1") * F.col("w1")
    total = F.col("all_n0") * F.col("w0") + F.col("all_n1") * F.col("w1")
    right = total - left
    p_left = F.col("n1") * F.col("w1") / left
    p_right = (F.col("all_n1") - F.col("n1")) * F.col("w1") / right
    gain = F.round(left / total * (right / total) * (p_left - p_right) * (p_left - p_right), 12)
    allowed = F.col("_next").isNotNull() & (F.col("rows") >= min_leaf) & (F.col("all_rows") - F.col("rows") >= min_leaf)
    half = F.col("value") / 2 + F.col("_next") / 2
    return cuts.select(
        *key,
        F.col("all_rows").alias("rows"),
        F.col("all_n0").alias("n0"),
        F.col("all_n1").alias("n1"),
        total.alias("weight"),
        (F.col("all_n1") * F.col("w1") / total).alias("p"),
        # Half way may round up to the upper value.
        F.when(half < F.col("_next"), half).otherwise(F.col("value")).alias("threshold"),
        F.when(allowed, gain).alias("gain"),
    )


def _best(cuts: DataFrame, draw: int, features: int, seed: int, min_split: int, max_depth: int | None) -> DataFrame:
    """One row per node with its best cut, if it is to be split."""
    depth = F.length("node")
    above = F.lit(True) if max_depth is None else depth < max_depth
    split = above & (F.col("n0") > 0) & (F.col("n1") > 0) & (F.col("rows") >= min_split) & F.col("gain").isNotNull()
    first, late = F.lit(True), F.lit(0)
    if draw < features:
        order = F.transform(
            F.sequence(F.lit(0), F.lit(features - 1)), lambda f: F.struct(F.xxhash64(F.lit(seed), "tree", "node", f), f.alias("f"))
        )
        place = F.array_position(F.transform(F.array_sort(order), lambda s: s["f"]), F.col("feature"))
        first, late = place <= draw, F.when(place > draw, place).otherwise(0)
    choice = F.struct(first.alias("in"), (-late).alias("late"), "gain", (-F.col("feature")).alias("f"), (-F.col("threshold")).alias("t"))
    node = cuts.groupBy("tree", "node").agg(
        *[F.max(c).alias(c) for c in ("rows", "n0", "n1", "weight", "p")], F.max(F.when(split, choice)).alias("_best")
    )
    return node.select(
        "tree", "node", depth.alias("depth"), "rows", "n0", "n1", "weight", "p", (-F.col("_best.f")).alias("feature"), (-F.col("_best.t")).alias("threshold"),
        F.col("_best.gain").alias("gain"),
    )


def importances(nodes: DataFrame) -> DataFrame:
    """Rows (feature, importance): each feature's share of a tree's decrease in impurity, averaged over trees that split at all."""
    gains = nodes.where(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("weight")).alias("g"))
    total = F.sum("g").over(W.partitionBy("tree"))
    shares = gains.select("tree", "feature", F.coalesce(F.try_divide("g", total), F.lit(0.0)).alias("share"))
    trees = shares.agg(F.count_distinct("tree")).scalar()
    return shares.groupBy("feature").agg((F.sum("share") / F.first(trees)).alias("importance"))


def rules(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows (tree, place, line): the rules of each tree, in order of ``place``."""
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("feature"))
    bars = F.repeat(F.lit("|   "), F.col("depth"))
    heads = nodes.where(F.col("feature").isNotNull())
    at = F.format_string("%.2f", "threshold")
    sides = F.array(
        F.struct(F.concat("node", F.lit("0")).alias("place"), F.concat(bars, F.lit("|--- "), name, F.lit(" <= "), at).alias("line")),
        F.struct(F.concat("node", F.lit("1")).alias("place"), F.concat(bars, F.lit("|--- "), name, F.lit(" >  "), at).alias("line")),
    )
    leaf = F.concat(bars, F.lit("|--- class: "), (F.col("p") > 0.5).cast("int").cast("string"))
    # "/" sorts before the turns 0 and 1, so a leaf follows its own heading.
    leaves = nodes.where(F.col("feature").isNull()).select("tree", F.concat("node", F.lit("/")).alias("place"), leaf.alias("line"))
    return heads.select("tree", F.inline(sides)).unionByName(leaves)


def forest_search(
    train: DataFrame,
    features: int,
    k: int,
    trees: Sequence[int],
    depths: Sequence[int | None],
    splits: Sequence[int],
    seed: int = 42,
) -> DataFrame:
    """All forests of a grid from one growth: rows (trees, max_depth, min_split, mean, std, best), judged by accuracy over ``k`` folds.

    A node's split depends on its rows, seed, tree and place only. Smaller forests are therefore the first trees of the largest one,
    and a lower depth or a larger split size cuts off the end of a held-out row's path: ``max(trees)`` trees a fold, grown to the weakest limits,
    hold every forest of the grid. ``train`` has id, x, y and fold. The first best row in order of depths, split sizes and trees wins.
    """
    most = max(trees)
    copies = train.withColumn("_f", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    copies = copies.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    held = F.col("fold") == F.col("_f")
    copies = copies.withColumn("n", F.when(held, F.lit(0)).otherwise(bagged("id", "_t", seed)).cast("long"))
    rows = copies.where(held | (F.col("n") > 0)).select((F.col("_t") * k + F.col("_f")).cast("long").alias("tree"), "id", "x", "y", "n")
    deepest = None if None in depths else max(depths)
    grown = grow(rows, features, deepest, min(splits), draw=max(isqrt(features), 1), seed=seed)
    return _judge(grown.landed, k, trees, depths, splits)


def _below(size: int):
    return lambda rows: rows < size


def _judge(landed: DataFrame, k: int, trees: Sequence[int], depths: Sequence[int | None], splits: Sequence[int]) -> DataFrame:
    last = F.size("path") - 1
    options = []
    for i, d in enumerate(depths):
        for j, s in enumerate(splits):
            small = F.array_position(F.transform(F.col("path")["rows"], _below(s)), True) - 1
            end = F.when(small >= 0, F.least(small.cast("int"), last)).otherwise(last)
            end = end if d is None else F.least(end, F.lit(d))
            options.append(F.struct(F.lit(i).alias("d"), F.lit(j).alias("s"), F.get("path", end)["p"].alias("p")))
    number = F.floor(F.col("tree") / k)
    votes = landed.select((F.col("tree") % k).alias("fold"), number.alias("t"), "id", "y", F.inline(F.array(*options)))
    means = votes.groupBy("fold", "id", "y", "d", "s").agg(
        F.array(
            *[F.struct(F.lit(n).alias("trees"), F.avg(F.when(F.col("t") < n, F.col("p"))).alias("p")) for n in trees]
        ).alias("m")
    )
    right = ((F.round("p", 12) > 0.5).cast("int") == F.col("y")).cast("double")
    folds = means.select("fold", "y", "d", "s", F.inline("m")).groupBy("fold", "d", "s", "trees").agg(F.avg(right).alias("score"))
    table = folds.groupBy("d", "s", "trees").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))
    place = F.array_position(F.array(*[F.lit(n) for n in trees]), F.col("trees"))
    order = F.struct(F.round("mean", 12).alias("m"), (-F.col("d")).alias("d"), (-F.col("s")).alias("s"), (-place).alias("t"))
    table = table.withColumn("_o", order)
    top = table.agg(F.max("_o")).scalar()
    depth = F.get(F.array(*[F.lit(d).cast("int") for d in depths]), F.col("d"))
    return table.select(
        "trees", depth.alias("max_depth"), F.get(F.array(*[F.lit(s) for s in splits]), F.col("s")).alias("min_split"), "mean", "std",
        (F.col("_o") == top).cast("int").alias("best"),
    )
