"""Density-based clusters, exact, over block joins and distributed connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from ledgerlark.operators import neighbours, packs
from ledgerlark.operators.neighbours import (
    block_join,
    build_tree,
    centre_distances,
    distinct_vectors,
    kth_distance,
)
from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.operators.ranking import with_running_totals
from ledgerlark.operators.skew import attach_by_key
from ledgerlark.session import cut_lineage

NOISE = -1
MAX_CENTRES = 10_000
FEW_EDGES = 200_000
#: Packs on each side of a task: a task sends out one edge and one count per point it holds.
GROUP = 32


def _count_within(eps: float) -> Callable:
    def compare(q, p):
        import numpy as np
        import pandas as pd

        if len(q) == 0 or len(p) == 0:
            return pd.DataFrame()
        y, w = np.stack(p["v"].to_numpy()), p["weight"].to_numpy()
        n = np.zeros(len(q), dtype=np.int64)
        for a, near in packs.within(np.stack(q["v"].to_numpy()), y, eps):
            n[a : a + len(near)] = near @ w
        return pd.DataFrame({"pid": q["pid"].to_numpy(), "n": n})

    return compare


def _spanning_edges(eps: float) -> Callable:
    def compare(q, p):
        import numpy as np
        import pandas as pd

        if len(q) == 0 or len(p) == 0:
            return pd.DataFrame()
        y = np.stack(p["v"].to_numpy())
        qid, pid = q["pid"].to_numpy(), p["pid"].to_numpy()
        near = np.vstack([tile for _, tile in packs.within(np.stack(q["v"].to_numpy()), y, eps)])
        todo, edges = near.any(axis=1), []
        while todo.any():
            front = np.zeros(len(q), dtype=bool)
            front[todo.argmax()] = True
            left, right = front.copy(), np.zeros(len(p), dtype=bool)
            while front.any():
                reached = near[front].any(axis=0) & ~right
                right |= reached
                front = near[:, reached].any(axis=1) & ~left
                left |= front
            todo &= ~left
            members = np.unique(np.concatenate([qid[left], pid[right]]))
            edges.append(pd.DataFrame({"a": members[1:], "b": members[0]}))
        edges = [e for e in edges if len(e)]
        return pd.concat(edges) if edges else pd.DataFrame()

    return compare


def _lowest_cluster_within(eps: float) -> Callable:
    def compare(q, p):
        import numpy as np
        import pandas as pd

        if len(q) == 0 or len(p) == 0:
            return pd.DataFrame()
        y, c = np.stack(p["v"].to_numpy()), p["cluster"].to_numpy()
        none = np.iinfo(np.int64).max
        best = np.full(len(q), none, dtype=np.int64)
        for a, near in packs.within(np.stack(q["v"].to_numpy()), y, eps):
            best[a : a + len(near)] = np.where(near, c[None, :], none).min(axis=1)
        hit = best < none
        if not hit.any():
            return pd.DataFrame()
        return pd.DataFrame({"pid": q["pid"].to_numpy()[hit], "cluster": best[hit]})

    return compare


def _count_in_packs(eps: float, enough: int) -> Callable:
    """Rows within ``eps`` of every point of the task's packs; those that have ``enough`` need no further ones."""

    def run(pairs):
        import numpy as np
        import pyarrow as pa

        ids, counts = {}, {}
        for a, b in pairs:
            for side in (a, b):
                if side.number not in counts:
                    ids[side.number], counts[side.number] = side["pid"].copy(), np.zeros(len(side.x), np.int64)
            n, m = counts[a.number], counts[b.number]
            rows = np.arange(len(n)) if m.min() < enough else np.flatnonzero(n < enough)
            cols = np.arange(len(m)) if n.min() < enough else np.flatnonzero(m < enough)
            if not len(rows) or not len(cols):
                continue
            w, u = b["weight"][cols], a["weight"][rows]
            for at, near in packs.within(a.x[rows], b.x[cols], eps):
                some = rows[at : at + len(near)]
                n[some] += near.sum(axis=1) if (w == 1).all() else near @ w
                if a.number != b.number:
                    m[cols] += near.sum(axis=0) if (u == 1).all() else u[at : at + len(near)] @ near
        for number, n in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids[number], from_pandas=True), pa.array(n)], names=["pid", "n"])

    return run


def _forest_in_packs(eps: float) -> Callable:
    """Edges that join the points of the task's packs which are connected by steps of at most ``eps`` there."""

    def run(pairs):
        import numpy as np
        import pyarrow as pa

        places, ids, root = {}, [], np.empty(0, np.int64)
        for a, b in pairs:
            for side in (a, b):
                if side.number not in places:
                    places[side.number] = np.arange(len(root), len(root) + len(side.x))
                    ids.append(side["pid"].copy())
                    root = np.concatenate([root, places[side.number]])
            left, right = places[a.number], places[b.number]
            rows, cols = np.arange(len(left)), np.arange(len(right))
            if (root[right] == root[right[0]]).all():
                rows = np.flatnonzero(root[left] != root[right[0]])
            elif (root[left] == root[left[0]]).all():
                cols = np.flatnonzero(root[right] != root[left[0]])
            if not len(rows) or not len(cols):
                continue
            for at, near in packs.within(a.x[rows], b.x[cols], eps):
                r, c = np.nonzero(near)
                _join_roots(root, root[left[rows[at + r]]], root[right[cols[c]]])
        if ids:
            ids = np.concatenate(ids)
            off = np.flatnonzero(root != np.arange(len(root)))
            edge = [pa.array(ids[off], from_pandas=True), pa.array(ids[root[off]], from_pandas=True)]
            yield pa.RecordBatch.from_arrays(edge, names=["a", "b"])

    return run


def _join_roots(root, x, y) -> None:
    """Give joined roots their smallest one, in place; ``root`` leads from every node straight to its root before and after."""
    import numpy as np

    differ = x != y
    x, y = x[differ], y[differ]
    while len(x):
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root[:] = up
        x, y = root[x], root[y]
        differ = x != y
        x, y = x[differ], y[differ]


def _lowest_in_packs(eps: float) -> Callable:
    def run(pairs):
        import numpy as np
        import pyarrow as pa

        none = np.iinfo(np.int64).max

        def results():
            if asked is not None:
                hit = best < none
                found = [pa.array(asked["pid"][hit], from_pandas=True), pa.array(best[hit])]
                yield pa.RecordBatch.from_arrays(found, names=["pid", "cluster"])

        asked, best = None, None
        for a, b in pairs:
            if a is not asked:
                yield from results()
                asked, best = a, np.full(len(a.x), none)
            rows = np.flatnonzero(best > b["cluster"].min())
            if not len(rows):
                continue
            order = np.argsort(b["cluster"], kind="stable")
            clusters = b["cluster"][order]
            for at, near in packs.within(a.x[rows], b.x[order], eps):
                first = np.where(near.any(axis=1), clusters[near.argmax(axis=1)], none)
                some = rows[at : at + len(near)]
                best[some] = np.minimum(best[some], first)
        yield from results()

    return run


def connected_components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Rows (node, component) for edges (a, b); the component is its smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): every node is hooked
    to the smallest node it can see, with a minimum per node and a salted join, until nothing
    changes. At most ``few`` edges are settled in one task instead.
    """
    e = cut_lineage(edges.where(F.col("a") != F.col("b")).distinct())
    state = _edge_state(e)
    while state[0] > few:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_lowest(both).where(F.col("b") > F.col("a"))
        down = large.select(F.col("b").alias("a"), F.col("low").alias("b"))
        down = _with_lowest(down.where(F.col("a") != F.col("b")).distinct())
        small = down.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            down.select("a", F.col("low").alias("b"))
        )
        e = cut_lineage(small.where(F.col("a") != F.col("b")).distinct())
        before, state = state, _edge_state(e)
        if state == before:
            break
    else:
        e = e.coalesce(1).mapInPandas(_settle_edges(), e.schema)
    roots = e.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _edge_state(e: DataFrame) -> tuple:
    return tuple(
        e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _with_lowest(edges: DataFrame) -> DataFrame:
    """Add to each edge (a, b) the smallest node among ``a`` and all its neighbours."""
    low = edges.groupBy("a").agg(F.min("b").alias("_b"), F.count(F.lit(1)).alias("_rows"))
    low = low.select("a", F.least("a", "_b").alias("low"), "_rows")
    return attach_by_key(edges, low, ["a"], "_rows").drop("_rows")


def _settle_edges() -> Callable:
    def settle(batches):
        import pandas as pd

        parent = {}

        def root(x):
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for pdf in batches:
            for x, y in zip(pdf["a"], pdf["b"]):
                low, high = sorted((root(x), root(y)))
                parent[high] = low
                parent.setdefault(low, low)
        nodes = [x for x in parent if root(x) != x]
        if nodes:
            yield pd.DataFrame({"a": nodes, "b": [root(x) for x in nodes]})

    return settle


def dbscan(
    df: DataFrame, row_id: str, vector: str, eps: float, min_samples: int, target: str = "cluster"
) -> DataFrame:
    """Add the cluster of each row, -1 for noise.

    A point counts itself; ``eps`` is inclusive. Clusters are numbered by their smallest core row
    id, and a border point joins the lowest cluster it touches.
    """
    tree, placed = build_tree(distinct_vectors(df, row_id, vector))
    placed = placed.withColumn("reach", F.lit(float(eps)))
    id_type = dict(df.dtypes)[row_id]
    counts, pairs, lowest = f"pid {id_type}, n bigint", f"a {id_type}, b {id_type}", f"pid {id_type}, cluster bigint"
    packed = placed.count() <= neighbours.MANY
    if packed:
        all_packs = packs.packs(placed, ["pid", "weight"], neighbours.BLOCK, GROUP)
        counted = packs.meet(all_packs, all_packs, _count_in_packs(eps, min_samples), counts, packs.each_once())
    else:
        counted = block_join(tree.visits(placed), placed, _count_within(eps), counts)
    degree = counted.groupBy("pid").agg(F.sum("n").alias("degree"))
    known = cut_lineage(placed.join(degree, "pid"))
    core = known.where(F.col("degree") >= min_samples)
    if packed:
        core_packs = packs.packs(core, ["pid"], neighbours.BLOCK, GROUP)
        edges = packs.meet(core_packs, core_packs, _forest_in_packs(eps), pairs, packs.each_once())
    else:
        edges = block_join(tree.visits(core, later_cells_only=True), core, _spanning_edges(eps), pairs)
    component = connected_components(edges)
    rooted = core.join(component, F.col("pid") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "pid")
    )
    rooted = rooted.drop("node")
    roots = rooted.groupBy("component").agg(F.count(F.lit(1)).alias("_rows"))
    numbered = with_running_totals(roots.withColumn("one", F.lit(1)), "component", ["one"]).select(
        "component", "_rows", (F.col("cum_one") - 1).cast("bigint").alias("cluster")
    )
    core_clusters = attach_by_key(rooted, numbered, ["component"], "_rows")
    core_clusters = cut_lineage(core_clusters.drop("component", "_rows"))
    rest = known.where(F.col("degree") < min_samples)
    if packed:
        left = packs.packs(rest, ["pid"], neighbours.BLOCK, GROUP)
        right = packs.packs(core_clusters.drop("reach"), ["cluster"], neighbours.BLOCK, GROUP)
        border = packs.meet(left, right, _lowest_in_packs(eps), lowest)
    else:
        border = block_join(tree.visits(rest), core_clusters, _lowest_cluster_within(eps), lowest)
    border = border.groupBy("pid").agg(F.min("cluster").alias("cluster"))
    settled = cut_lineage(core_clusters.select("pid", "cluster").unionByName(border))
    per_vector = known.join(settled, "pid", "left").select(
        F.col("v").alias(vector),
        F.coalesce(F.col("cluster"), F.lit(NOISE)).cast("int").alias(target),
        "weight",
    )
    return attach_by_key(df, per_vector, [vector], "weight").drop("weight")


def adaptive_eps(
    df: DataFrame, row_id: str, vector: str, k: int = 5, share: float = 0.9, method: str = "index"
) -> DataFrame:
    """One row ``eps``: the ``share`` rank (``index``) or percentile (``linear``) of k-distances."""
    distances = cut_lineage(kth_distance(df, row_id, vector, k).select("kth_distance"))  # read by each scan of the selection
    q = exact_quantiles(distances, ["kth_distance"], [share], method=method)
    return q.select(F.col("value").alias("eps"))


def summary(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One row: clusters without noise, noise rows and their share in percent."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    noise = F.coalesce(F.sum(F.when(F.col(cluster) == NOISE, F.col("n"))), F.lit(0))
    return sizes.agg(
        F.count_if(F.col(cluster) != NOISE).alias("clusters"),
        noise.alias("outliers"),
        (100.0 * noise / F.sum("n")).alias("outlier_pct"),
    )


def centroids(df: DataFrame, vector: str, cluster: str) -> list[tuple[int, list[float]]]:
    """Mean vector per cluster, in cluster order; there must be few clusters."""
    means = df.groupBy(cluster).agg(Summarizer.mean(array_to_vector(vector)).alias("m"))
    rows = means.limit(MAX_CENTRES + 1).collect()
    if len(rows) > MAX_CENTRES:
        raise ValueError(f"more than {MAX_CENTRES} clusters")
    return sorted((r[cluster], [float(x) for x in r["m"].toArray()]) for r in rows)


def reassign_noise(df: DataFrame, vector: str, cluster: str = "cluster") -> DataFrame:
    """Move noise to the cluster with the nearest mean, the lowest on ties, and number from 0.

    The means are those of the original clusters. Without any cluster the noise becomes cluster 0.
    """
    means = centroids(df.where(F.col(cluster) != NOISE), vector, cluster)
    if not means:
        return df.withColumn(cluster, F.lit(0))
    d = centre_distances(F.col(vector), [c for _, c in means])
    nearest = (F.array_position(d, F.array_min(d)) - 1).cast("int")
    old = F.array(*[F.lit(c) for c, _ in means])
    own = (F.array_position(old, F.col(cluster)) - 1).cast("int")
    return df.withColumn(cluster, F.when(F.col(cluster) == NOISE, nearest).otherwise(own))
