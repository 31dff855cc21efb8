"""Exact nearest-neighbour and range searches as block joins over a metric tree.

Points go down a tree that is built level by level: every node of more than ``BLOCK`` points draws up to ``FAN`` pivots
among them, and its points go to the nearest one, until each leaf holds at most ``BLOCK``. A query goes down from the
root to the children that the triangle inequality cannot rule out. The queries that visit a leaf are cut into blocks, so
every task compares at most about ``BLOCK`` queries with ``BLOCK`` points, at any number of points. Tasks send out
per-query results (the k best, a count, a spanning edge), never the pairs. Equal vectors are merged before, so a large
group of copies costs one point. A level's pivots are broadcast if they take at most ``SENT`` bytes, as the upper levels with
their large nodes do; beyond, rows meet the pivots of their node by a join.

In many dimensions nearly every query visits every leaf, and a row per query and leaf would be many times the table. So up to ``MANY``
points the leaves meet as packs (``packs.py``), which costs no shuffle; beyond, a table of all pairs of packs would be too long.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.functions.scalars import literal_matrix, squared_distance
from ledgerlark.operators import packs
from ledgerlark.operators.skew import attach_by_key, top_k_per_group
from ledgerlark.session import cut_lineage

BLOCK = 2048
FAN = 16
#: Bytes of pivots, and rows of a table of nodes, that may be broadcast.
SENT, SENT_ROWS = 32 << 20, 100_000
#: Points up to which leaves meet as packs.
MANY = 8_000_000
#: Packs of queries and of points that a task holds: few results per query, and enough tasks.
ASKED, POOL = 8, 64


def distinct_vectors(df: DataFrame, row_id: str, vector: str) -> DataFrame:
    """One row (pid, v, weight) per distinct vector; ``pid`` is the smallest row id."""
    return df.groupBy(F.col(vector).alias("v")).agg(
        F.min(row_id).alias("pid"), F.count(F.lit(1)).alias("weight")
    )


@dataclass(frozen=True)
class Tree:
    """Per level the children (node, cell, pivot, radius, n, least) of the nodes that were split there; the root is ''.

    ``least`` is the smallest weight of a child's points.
    """

    levels: list[DataFrame]

    def home(self, queries: DataFrame, k: int) -> DataFrame:
        """Add the leaf of the nearest pivots (``cell``) and a distance within which ``k`` points lie (``reach``)."""
        rows = queries.withColumns({"visit": F.lit(""), "reach": F.lit(float("inf"))})
        for level in self.levels:
            rows = _step_down(rows, level, _nearest_child(k))
        return rows.withColumnRenamed("visit", "cell")

    def visits(self, queries: DataFrame, later_cells_only: bool = False, step: Callable | None = None) -> DataFrame:
        """One row per query and leaf (``visit``) that may hold points within the query's ``reach``.

        With ``later_cells_only`` a query skips leaves before its own, which finds each unordered pair
        of a self-join once. Another ``step`` may choose the children by other bounds.
        """
        rows = queries.withColumn("visit", F.lit(""))
        for level in self.levels:
            rows = _step_down(rows, level, step or near_children(_within_reach))
        return rows.where("visit >= cell") if later_cells_only else rows


def _sent(table: DataFrame, rows: int) -> DataFrame:
    """The table for a join: broadcast if it is known to be short."""
    return F.broadcast(table) if rows <= SENT_ROWS else table


def _distances(x, y):
    import numpy as np

    return np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))


def _nearest_child(k: int) -> Callable:
    """A step to the nearest pivot, where ``reach`` shrinks to the ball of any child with ``k`` points."""

    def step(part, children):
        import numpy as np

        cell, pivot, radius, n, _ = children
        at, gap = np.empty(len(part), np.int64), np.empty(len(part))
        reach = part["reach"].to_numpy(float).copy()
        x = np.stack(part["v"].to_numpy())
        for a in range(0, len(x), 128):
            d = _distances(x[a : a + 128], pivot)
            at[a : a + 128], gap[a : a + 128] = d.argmin(axis=1), d.min(axis=1)
            ball = np.where(n >= k, d + radius, np.inf).min(axis=1) * (1 + 1e-9)
            reach[a : a + 128] = np.minimum(reach[a : a + 128], ball)
        out = part.assign(visit=cell[at], reach=reach)
        return out.assign(gap=gap) if "gap" in part else out

    return step


def _within_reach(part, radius, least):
    return part["reach"].to_numpy(float)[:, None]


def near_children(reach: Callable) -> Callable:
    """A step to every child whose ball comes within ``reach(part, radius, least)`` of a query."""

    def step(part, children):
        import numpy as np
        import pandas as pd

        cell, pivot, radius, _, least = children
        x, out = np.stack(part["v"].to_numpy()), []
        for a in range(0, len(x), 128):
            some = part.iloc[a : a + 128]
            d = _distances(x[a : a + 128], pivot)
            rows, cols = np.nonzero(d - radius <= reach(some, radius, least) + 1e-9 * (1.0 + d))
            out.append(some.iloc[rows].assign(visit=cell[cols]))
        return pd.concat(out)

    return step


def _arrays(children):
    import numpy as np

    radius, n, least = (children[c].to_numpy(float) for c in ("radius", "n", "least"))
    return children["cell"].to_numpy(object), np.stack(children["pivot"].to_numpy()), radius, n, least


def _step_down(rows: DataFrame, level: DataFrame, step: Callable) -> DataFrame:
    """``step`` the rows at nodes of the level to children; other rows stay where they are."""
    first = level.agg(F.count(F.lit(1)), F.max(F.size("pivot"))).first()
    if first[0] * (first[1] or 0) * 8 <= SENT:
        nodes = {node: _arrays(part) for node, part in level.toPandas().groupby("node")}
        shared = rows.sparkSession.sparkContext.broadcast(nodes)

        def run(batches):
            for pdf in batches:
                for node, at in pdf.groupby("visit").indices.items():
                    part = pdf.iloc[at]
                    yield step(part, shared.value[node]) if node in shared.value else part

        return rows.mapInPandas(run, rows.schema)
    nodes = level.select(F.col("node").alias("visit")).distinct()
    stay = rows.join(nodes, "visit", "left_anti").select(*rows.columns)
    left, right = _blocks(rows.join(nodes, "visit", "left_semi"), level.withColumnRenamed("node", "visit"))
    keys = ["visit", "_block"]

    def meet(part, children):
        return step(part.drop(columns="_block"), _arrays(children)) if len(part) and len(children) else part.drop(columns="_block")[:0]

    down = left.select(*rows.columns, "_block").groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, rows.schema)
    return stay.unionByName(down)


def _blocks(left: DataFrame, right: DataFrame, rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_block``: the left rows of a ``visit`` in blocks of about ``BLOCK``, the right ones once for each.

    ``rows`` says how many rows at most the left side has if there is one ``visit`` only.
    """
    if rows is not None:
        blocks = max(1, ceil(rows / BLOCK))
        left = left.withColumn("_block", F.pmod(F.xxhash64("pid", F.lit(7)), F.lit(blocks)).cast("int"))
        right = right.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return left.toDF(*left.columns), right.toDF(*right.columns)
    load = left.groupBy("visit").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    load = cut_lineage(load)
    load = _sent(load, load.count())
    left = left.join(load, "visit").withColumn("_block", F.pmod(F.xxhash64("pid", F.lit(7)), F.col("_blocks")).cast("int"))
    right = right.join(load, "visit").withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    left, right = left.drop("_blocks"), right.drop("_blocks")
    return left.toDF(*left.columns), right.toDF(*right.columns)  # either may come from the other


def build_tree(points: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree over (pid, v, ...), and the points with their leaf as ``cell``.

    A leaf holds more than ``BLOCK`` points only if their vectors are equal; ``weight`` counts as 1 if it is not there.
    """
    placed = cut_lineage(points.withColumns({"visit": F.lit(""), "gap": F.lit(0.0), "reach": F.lit(0.0)}))
    if placed.count() <= BLOCK:
        return Tree([]), placed.withColumnRenamed("visit", "cell").drop("gap", "reach")
    weight = F.min("weight") if "weight" in points.columns else F.lit(1)
    sizes = placed.groupBy(F.col("visit").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    levels: list[DataFrame] = []
    while True:
        full = cut_lineage(sizes.where(F.col("n") > BLOCK))
        many = full.count()
        if not many:
            break
        hashed = F.xxhash64("pid", F.lit(len(levels)))
        drawn = placed.join(_sent(full, many), F.col("visit") == F.col("node")).where(F.pmod(hashed, F.col("n")) < 4 * FAN)
        number = F.row_number().over(W.partitionBy("node").orderBy(hashed, "pid"))
        children = drawn.select("node", number.alias("i"), F.col("v").alias("pivot")).where(F.col("i") <= FAN)
        children = cut_lineage(children.select("node", F.concat("node", F.format_string("/%02d", "i")).alias("cell"), "pivot"))
        level = children.withColumns({"radius": F.lit(0.0), "n": F.lit(0), "least": F.lit(0)})
        placed = cut_lineage(_step_down(placed, level, _nearest_child(1)))
        stats = placed.groupBy(F.col("visit").alias("cell")).agg(
            F.max("gap").alias("radius"), F.count(F.lit(1)).alias("n"), weight.alias("least")
        )
        levels.append(cut_lineage(children.join(stats, "cell")))
        sizes = levels[-1].where("radius > 0").select(F.col("cell").alias("node"), "n")
    return Tree(levels), placed.withColumnRenamed("visit", "cell").drop("gap", "reach")


def block_join(
    visiting: DataFrame, points: DataFrame, compare: Callable, schema: str, rows: int | None = None
) -> DataFrame:
    """Run ``compare(queries, points)`` on pandas blocks of bounded size.

    ``visiting`` needs ``pid``, ``v`` and ``visit``; ``points`` needs ``pid``, ``v`` and ``cell``. With a tree of one
    leaf ``rows`` may say how many queries there are at most.
    """
    left, right = _blocks(visiting, points.withColumnRenamed("cell", "visit"), rows)
    keys = ["visit", "_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, schema)


def _nearest_in_block(k: int) -> Callable:
    def compare(q, p):
        import numpy as np
        import pandas as pd

        if len(q) == 0 or len(p) == 0:
            return pd.DataFrame()
        x, y = np.stack(q["v"].to_numpy()), np.stack(p["v"].to_numpy())
        best, product, ids = packs.Nearest(len(x), k), packs.Product(x, y), p["nid"].to_numpy()
        for a in range(0, len(x), packs.TILE):
            rows, cols = packs.at_most(product, a, best.limits(), k)
            best.add(a + rows, packs.distances(x, y, a + rows, cols), ids[cols])
        pid = np.repeat(q["pid"].to_numpy(), best.found.sum(axis=1))
        return pd.DataFrame({"pid": pid, "nid": best.ids[best.found], "distance": best.d[best.found]})

    return compare


def _nearest_in_packs(k: int) -> Callable:
    def run(pairs):
        import numpy as np
        import pyarrow as pa

        def results():
            if best is None or best.ids is None:
                return
            d, pid, nid = best.d[best.found], np.repeat(asked["pid"], best.found.sum(axis=1)), best.ids[best.found]
            columns = [pa.array(pid, from_pandas=True), pa.array(nid, from_pandas=True), pa.array(d)]
            yield pa.RecordBatch.from_arrays(columns, names=["pid", "nid", "distance"])

        asked, best = None, None
        for a, b in pairs:
            if a is not asked:
                yield from results()
                asked, best = a, packs.Nearest(len(a.x), k)
            limits = np.minimum(best.limits(), a["reach"] * (1 + 1e-9))
            gap = np.sqrt(((a.x - b.middle) ** 2).sum(axis=1))
            rows = np.flatnonzero(~(gap - b.radius > limits + 1e-9 * (1 + gap)))
            if not len(rows):
                continue
            product = packs.Product(a.x[rows], b.x)
            for at in range(0, len(rows), packs.TILE):
                r, c = packs.at_most(product, at, limits[rows], k)
                best.add(rows[at + r], packs.distances(product.x, b.x, at + r, c), b["nid"][c])
        yield from results()

    return run


def nearest_neighbours(
    queries: DataFrame, points: DataFrame, k: int, query_id: str, point_id: str, vector: str
) -> DataFrame:
    """Rows (pid, v, nid, distance, rank) for each distinct query vector; ties by point id.

    ``pid`` is the smallest query id of the vector. Of equal points only the ``k`` with the
    smallest ids can be among the k nearest, so the others are left out beforehand.
    """
    reduced = top_k_per_group(
        points.select(F.col(point_id).alias("nid"), F.col(vector).alias("v")),
        ["v"],
        [F.col("nid")],
        k,
        "nid",
    )
    pool = reduced.withColumn("pid", F.col("nid"))
    tree, placed = build_tree(pool)
    asked = cut_lineage(tree.home(distinct_vectors(queries, query_id, vector), k))
    id_type = dict(points.dtypes)[point_id]
    schema = f"pid {dict(queries.dtypes)[query_id]}, nid {id_type}, distance double"
    compare = _nearest_in_block(k)
    reaching = asked
    if tree.levels:
        first = block_join(asked.withColumn("visit", F.col("cell")), placed, compare, schema)
        bound = first.groupBy("pid").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("_own"))
        reaching = asked.join(bound, "pid", "left").withColumn("reach", F.least("reach", "_own")).drop("_own")
    if max(asked.count(), placed.count()) <= MANY:
        left = packs.packs(cut_lineage(reaching), ["pid", "reach"], BLOCK, ASKED)
        found = packs.meet(left, packs.packs(placed.drop("reach"), ["nid"], BLOCK, POOL), _nearest_in_packs(k), schema)
    else:
        found = block_join(cut_lineage(tree.visits(reaching)), placed, compare, schema)
    order = W.partitionBy("pid").orderBy("distance", "nid")
    # Callers read the result several times, and the search is not to run again for each.
    ranked = cut_lineage(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    return ranked.join(asked.select("pid", "v", "weight"), "pid")


def kth_distance(df: DataFrame, row_id: str, vector: str, k: int = 5) -> DataFrame:
    """Add the distance to the k-th neighbour, the row itself being the first."""
    near = nearest_neighbours(df, df, k, row_id, row_id, vector)
    per_vector = near.groupBy("v").agg(
        F.max("distance").alias("kth_distance"), F.max("weight").alias("weight")
    )
    renamed = per_vector.withColumnRenamed("v", vector)
    return attach_by_key(df, renamed, [vector], "weight").drop("weight")


def knn_classify(
    train: DataFrame, test: DataFrame, row_id: str, vector: str, label: str, k: int = 5
) -> DataFrame:
    """Add ``pred``: the majority label of the k nearest training rows, the smallest on ties."""
    near = nearest_neighbours(test, train, k, row_id, row_id, vector)
    asked_for = near.groupBy("nid").agg(F.count(F.lit(1)).alias("_times"))
    labels = train.select(F.col(row_id).alias("nid"), F.col(label).alias("_label"))
    labelled = attach_by_key(near, asked_for.join(labels, "nid"), ["nid"], "_times")
    votes = labelled.groupBy("v", "weight", "_label").agg(F.count(F.lit(1)).alias("n"))
    pick = votes.groupBy("v", "weight").agg(
        F.max_by("_label", F.struct(F.col("n"), -F.col("_label"))).alias("pred")
    )
    renamed = pick.withColumnRenamed("v", vector)
    return attach_by_key(test, renamed, [vector], "weight").drop("weight")


def nearest_centre(vector: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre, the lowest on ties; the centres are few and travel as literals."""
    d = centre_distances(vector, centres)
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def centre_distances(vector: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Array of squared distances to each centre."""
    return F.transform(literal_matrix(centres), lambda c: squared_distance(vector, c))
