"""Trees against a plain recursive CART, bags, rules and the shared growth of a grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import trees


def cart(x, y, limit, min_split, w=(1.0, 1.0), node="", depth=0):
    """{node: (rows, n1, feature, threshold)} by trying every cut."""
    n1 = int(y.sum())
    out = {node: (len(y), n1, None, None)}
    if n1 in (0, len(y)) or len(y) < min_split or depth == limit:
        return out
    best, total = None, (len(y) - n1) * w[0] + n1 * w[1]
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, one = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero(v[1:] > v[:-1])
        if not len(at):
            continue
        l1, ln = one[at], at + 1
        left = (ln - l1) * w[0] + l1 * w[1]
        right = total - left
        gain = np.round(left / total * (right / total) * (l1 * w[1] / left - (n1 - l1) * w[1] / right) ** 2, 12)
        top = int(gain.argmax())
        cut = v[at[top]] / 2 + v[at[top] + 1] / 2
        if best is None or gain[top] > best[0]:
            best = (gain[top], f, cut)
    if best is None:
        return out
    _, f, cut = best
    out[node] = (len(y), n1, f, cut)
    go = x[:, f] <= cut
    for side, part in (("0", go), ("1", ~go)):
        out |= cart(x[part], y[part], limit, min_split, w, node + side, depth + 1)
    return out


def table(spark, x, y):
    rows = [(0, i, [float(v) for v in x[i]], int(y[i]), 1) for i in range(len(y))]
    return spark.createDataFrame(rows, "tree bigint, id bigint, x array<double>, y int, n bigint")


def as_dict(nodes):
    return {r["node"]: (r["rows"], r["n1"], r["feature"], r["threshold"]) for r in nodes.collect()}


def points(n, seed):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 4, n), draw.exponential(size=n).round(1)])
    return x, (x[:, 0] + 0.5 * x[:, 1] + draw.normal(scale=0.6, size=n) > 1).astype(int)


@pytest.mark.parametrize("limit,min_split,bins", [(None, 600, 16), (3, 2, 1)])
def test_equals_plain_cart(spark, limit, min_split, bins):
    x, y = points(5000 if bins == 16 else 300, 3)
    grown = trees.grow(table(spark, x, y), 3, limit, min_split, bins=bins)
    assert as_dict(grown.nodes) == cart(x, y, limit, min_split)


def test_balanced_classes(spark):
    x, y = points(300, 5)
    w = (len(y) / (2 * (len(y) - y.sum())), len(y) / (2 * y.sum()))
    assert as_dict(trees.grow(table(spark, x, y), 3, 2, balanced=True).nodes) == cart(x, y, 2, 2, w)


def test_odd_tables(spark):
    empty = table(spark, np.zeros((0, 2)), np.zeros(0))
    assert trees.grow(empty, 2).nodes.count() == 0
    same = trees.grow(table(spark, np.ones((6, 2)), np.array([0, 1] * 3)), 2).nodes.collect()
    assert len(same) == 1 and same[0]["feature"] is None and same[0]["p"] == 0.5
    one_class = trees.grow(table(spark, np.arange(8.0).reshape(4, 2), np.ones(4)), 2).nodes.collect()
    assert len(one_class) == 1 and one_class[0]["p"] == 1.0
    missing = spark.createDataFrame(
        [(0, 1, [None], 1, 1), (0, 2, [5.0], 0, 1), (0, 3, [7.0], 0, 1)], "tree bigint, id bigint, x array<double>, y int, n bigint"
    )
    nodes = as_dict(trees.grow(missing, 1).nodes)
    assert nodes["0"][:2] == (1, 1) and nodes["1"][:2] == (2, 0)


def test_rules_and_importances(spark):
    x = np.array([[1.0, 0.0], [2.0, 0.0], [3.0, 1.0], [4.0, 0.0]])
    nodes = trees.grow(table(spark, x, np.array([0, 0, 1, 1])), 2).nodes
    lines = [r["line"] for r in trees.rules(nodes, ["a", "b"]).orderBy("place").collect()]
    assert lines == ["|--- a <= 2.50", "|   |--- class: 0", "|--- a >  2.50", "|   |--- class: 1"]
    assert [tuple(r) for r in trees.importances(nodes).collect()] == [(0, 1.0)]


def test_bags_have_mean_one(spark):
    bags = spark.range(20000).withColumn("t", F.lit(3)).select(trees.bagged("id", "t").alias("n"))
    r = bags.agg(F.avg("n"), F.var_pop("n"), F.avg((F.col("n") == 0).cast("int"))).first()
    assert abs(r[0] - 1) < 0.03 and abs(r[1] - 1) < 0.05 and abs(r[2] - np.exp(-1)) < 0.02


def test_grid_equals_forests_fitted_one_by_one(spark):
    """Each point read from the shared growth is what a growth under its own limits gives."""
    x, y = points(90, 8)
    df = spark.createDataFrame(
        [(i, [float(v) for v in x[i]], int(y[i]), i % 3) for i in range(90)], "id bigint, x array<double>, y int, fold int"
    )
    grid = trees.forest_search(df, 3, 3, [3, 6], [None, 2], [2, 12])
    whole = {(r["trees"], r["max_depth"], r["min_split"]): (r["mean"], r["std"]) for r in grid.collect()}
    assert len(whole) == 8 and grid.where("best = 1").count() == 1
    for point in [(3, 2, 12), (6, None, 12)]:
        own = trees.forest_search(df, 3, 3, [point[0]], [point[1]], [point[2]]).first()
        assert (own["mean"], own["std"]) == pytest.approx(whole[point])
    assert max(m for m, _ in whole.values()) > 0.7
