"""K-means, fuzzy c-means, subtractive and Ward clustering, and the runner for all of them.

Vectors are array columns of doubles. Centres are few and travel as literals; every pass over the
rows is an aggregation with map-side partial results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ledgerlark import presets
from ledgerlark.operators import neighbours, packs
from ledgerlark.operators.dbscan import adaptive_eps, connected_components, dbscan, reassign_noise
from ledgerlark.operators.neighbours import (
    block_join,
    build_tree,
    centre_distances,
    distinct_vectors,
    near_children,
    nearest_centre,
)
from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.operators.ranking import shuffle_key
from ledgerlark.operators.skew import attach_by_key
from ledgerlark.session import cut_lineage, rewritten

Centres = list[list[float]]

CANDIDATES = 256
#: Bytes of means of groups, and cheapest partners of each, from which a task takes Ward's merges.
MERGED, PARTNERS = 1 << 27, 16
#: Balls from whose bounds the densest points are looked for; any number gives the same centres.
BALLS = 4096
#: Batches of candidates after which the balls' bounds give way to those of all pairs, and packs on each side of a task for these.
LOOSE, PAIRED = 4, 32


def _as_lists(row) -> Centres:
    return [[float(x) for x in v.toArray()] for v in row]


# --- k-means ------------------------------------------------------------------------------------


#: Rows that a task compares with the centres of all runs at a time.
SLICE = 4096


def _slices(batches, *columns):
    """The vectors of Arrow batches as matrices of at most ``SLICE`` rows, with further columns."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            v = part.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
            yield x, *[part.column(c).to_numpy(zero_copy_only=False) for c in columns]


def _uniform(hashes, key: int):
    """Numbers between 0 and 1 from the hashes of rows and one number, mixed as splitmix64 does."""
    z = hashes.view(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def _draw_starts(rows: DataFrame, starts: list[Centres], seed: int) -> bool:
    """Add one start to every sequence in one scan; False if no vector is left to draw.

    A vector is drawn with a weight of its squared distance to the nearest start before: of all vectors the least
    ``-log(u) / d²`` wins, so tasks send out one candidate per sequence.
    """
    step = len(starts[0])

    def run(batches):
        import pyarrow as pa

        best = [(np.inf, None)] * len(starts)
        for x, hashes in _slices(batches, "h"):
            for j, chosen in enumerate(starts):
                race = -np.log(_uniform(hashes, seed + 1000 * step + j))
                if chosen:
                    d2 = np.min([((x - np.asarray(c)) ** 2).sum(axis=1) for c in chosen], axis=0)
                    race = np.divide(race, d2, out=np.full(len(x), np.inf), where=d2 > 0)
                i = race.argmin()
                if race[i] < best[j][0]:
                    best[j] = (float(race[i]), x[i].tolist())
        found = [(j, e, v) for j, (e, v) in enumerate(best) if v is not None]
        columns = list(zip(*found)) or [(), (), ()]
        types = [pa.int32(), pa.float64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["j", "race", "v"]
        )

    found = rows.mapInArrow(run, "j int, race double, v array<double>")
    drawn = found.groupBy("j").agg(F.min(F.struct("race", "v")).alias("m")).collect()
    for r in drawn:
        starts[r["j"]].append(list(r["m"]["v"]))
    return bool(drawn)


def _scan_runs(rows: DataFrame, runs: list[Centres]) -> list[tuple[Centres, float]]:
    """The means of each run's clusters and the cost of its centres, for all runs in one scan.

    Tasks send out one sum of vectors per centre. An empty cluster keeps its centre.
    """
    ends = np.cumsum([0] + [len(c) for c in runs])

    def run(batches):
        import pyarrow as pa

        c = np.concatenate([np.asarray(r, dtype=float) for r in runs])
        middle = c.mean(axis=0)
        near, half = (c - middle).T, ((c - middle) ** 2).sum(axis=1) / 2
        n, cost, total = np.zeros(len(c), np.int64), np.zeros(len(c)), np.zeros_like(c)
        for (x,) in _slices(batches):
            gain = (x - middle) @ near - half
            for a, b in zip(ends, ends[1:]):
                at = gain[:, a:b].argmax(axis=1)
                member = (at[:, None] == np.arange(b - a)).astype(float)
                n[a:b] += member.sum(axis=0).astype(np.int64)
                total[a:b] += member.T @ x
                cost[a:b] += ((x - c[a:b][at]) ** 2).sum(axis=1) @ member
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array(n[some]),
                pa.array(cost[some]),
                pa.array(list(total[some]), pa.list_(pa.float64())),
            ],
            names=["at", "n", "cost", "total"],
        )

    sums = rows.select("v").mapInArrow(run, "at int, n long, cost double, total array<double>")
    sums = sums.groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), Summarizer.sum(array_to_vector("total")).alias("total")
    )
    found = {r["at"]: r for r in sums.collect()}
    out = []
    for a, centres in zip(ends, runs):
        rows_of = [found.get(a + j) for j in range(len(centres))]
        means = [
            c if r is None else [float(x) / r["n"] for x in r["total"].toArray()] for r, c in zip(rows_of, centres)
        ]
        out.append((means, sum(r["cost"] for r in rows_of if r)))
    return out


def kmeans_runs(
    df: DataFrame,
    vector: str,
    ks: Sequence[int],
    restarts: int = presets.KMEANS_RESTARTS,
    seed: int = 42,
    max_rounds: int = presets.KMEANS_ROUNDS,
    tolerance: float = 1e-4,
) -> dict[int, tuple[Centres, float]]:
    """Per number of centres the best of several seeded runs: its centres and their inertia.

    All runs of all numbers share the scans: one per start drawn (the runs of one restart take the first ``k`` starts of
    one sequence), one per round of means, where a run whose centres have settled takes no more part, and one for the
    final inertias. Starts are drawn over all vectors, by hash and not by place, copies once; means and inertias count
    every row. NULL vectors take no part. Where fewer distinct vectors exist than ``k``, there are fewer centres.
    """
    rows = df.where(F.col(vector).isNotNull()).select(
        F.col(vector).cast("array<double>").alias("v"), F.xxhash64(vector).alias("h")
    )
    rows = rows.persist()
    try:
        starts: list[Centres] = [[] for _ in range(restarts)]
        for _ in range(max(ks)):
            if not _draw_starts(rows, starts, seed):
                break
        names = [(k, j) for k in ks for j in range(1 if k == 1 else restarts)]
        runs = {name: starts[name[1]][: name[0]] for name in names}
        if not starts[0]:
            return {k: ([], 0.0) for k in ks}
        live = names
        for _ in range(max_rounds):
            moved = []
            for name, (means, _) in zip(live, _scan_runs(rows, [runs[n] for n in live])):
                gaps = ((np.array(means) - np.array(runs[name])) ** 2).sum(axis=1)
                runs[name] = means
                if gaps.max() > tolerance**2:
                    moved.append(name)
            live = moved
            if not live:
                break
        costs = dict(zip(names, (cost for _, cost in _scan_runs(rows, [runs[n] for n in names]))))
    finally:
        rows.unpersist()
    best = {k: min((n for n in names if n[0] == k), key=lambda n: (costs[n], n)) for k in ks}
    return {k: (runs[n], float(costs[n])) for k, n in best.items()}


def kmeans(
    df: DataFrame,
    vector: str,
    k: int,
    restarts: int = presets.KMEANS_RESTARTS,
    seed: int = 42,
    max_rounds: int = presets.KMEANS_ROUNDS,
) -> tuple[Centres, float]:
    """Best centres of several seeded runs, and their inertia."""
    return kmeans_runs(df, vector, [k], restarts, seed, max_rounds)[k]


def inertia(df: DataFrame, vector: str, centres: Centres) -> float:
    return df.agg(F.sum(F.array_min(centre_distances(F.col(vector), centres)))).first()[0]


def assign(df: DataFrame, vector: str, centres: Centres, target: str = "cluster") -> DataFrame:
    return df.withColumn(target, nearest_centre(F.col(vector), centres))


def lloyd(df: DataFrame, vector: str, start: Centres, rounds: int) -> Centres:
    """A fixed number of k-means rounds from given centres; an empty cluster keeps its centre."""
    centres = [list(c) for c in start]
    for _ in range(rounds):
        means = (
            assign(df, vector, centres, "_c")
            .groupBy("_c")
            .agg(Summarizer.mean(array_to_vector(vector)).alias("m"))
        )
        for r in means.collect():
            centres[r["_c"]] = [float(x) for x in r["m"].toArray()]
    return centres


def inertia_curve(
    df: DataFrame, vector: str, ks: Sequence[int], restarts: int = 10, seed: int = 42
) -> DataFrame:
    """Rows (k, inertia), from scans that all numbers share."""
    found = kmeans_runs(df, vector, [int(k) for k in ks], restarts, seed)
    rows = [(k, cost) for k, (_, cost) in found.items()]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def elbow(curve: DataFrame) -> DataFrame:
    """One row ``k``: the point of the curve farthest from the chord, the smallest k on ties."""
    ends = curve.agg(
        F.struct(
            F.min("k").alias("k0"),
            F.min_by("inertia", "k").alias("y0"),
            F.max("k").alias("k1"),
            F.max_by("inertia", "k").alias("y1"),
        )
    ).scalar()
    e = F.col("_e")
    dx, dy = e["k1"] - e["k0"], e["y1"] - e["y0"]
    cross = F.abs(dx * (e["y0"] - F.col("inertia")) - dy * (e["k0"] - F.col("k")))
    distance = F.round(cross / F.sqrt(dx * dx + dy * dy), 12)
    placed = curve.withColumn("_e", ends).select("k", distance.alias("_d"))
    return placed.orderBy(F.col("_d").desc(), "k").limit(1).select("k")


# --- fuzzy c-means ------------------------------------------------------------------------------


def _weights(centres: Centres, vector: str, prefix: str, m: float) -> list[str]:
    """SQL of ``d² ** (-1 / (m - 1))`` per centre, from which memberships follow by division."""
    tiny = float(np.finfo(np.float64).eps) ** 2
    out = []
    for j, c in enumerate(centres):
        centre = f"array({', '.join(repr(float(x)) + 'D' for x in c)})"
        d2 = (
            f"aggregate(zip_with({vector}, {centre}, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)"
        )
        out.append(f"pow(greatest({d2}, {tiny!r}D), {-1.0 / (m - 1)!r}D) AS {prefix}{j}")
    return out


def _fuzzy_round(
    rows: DataFrame, vector: str, now: Centres, before: Centres | None, m: float
) -> tuple[Centres, float]:
    """The centres after ``now``, and the squared change of the memberships since ``before``."""
    c = len(now)
    names = [("_w", now)] + ([("_o", before)] if before else [])
    weighed = rows.selectExpr("_v", *[x for p, s in names for x in _weights(s, vector, p, m)])
    totals = [f"{' + '.join(f'{p}{j}' for j in range(c))} AS {p}" for p, _ in names]
    weighed = weighed.selectExpr("*", *totals)
    means = [
        Summarizer.mean(F.col("_v"), F.expr(f"pow(_w{j} / _w, {m!r}D)")).alias(f"m{j}")
        for j in range(c)
    ]
    change = F.lit(float("inf"))
    if before:
        squares = [f"pow(_w{j} / _w - _o{j} / _o, 2)" for j in range(c)]
        change = F.sum(F.expr(" + ".join(squares)))
    row = weighed.agg(change.alias("change"), *means).first()
    return _as_lists([row[f"m{j}"] for j in range(c)]), row["change"]


def fuzzy_cmeans(
    df: DataFrame,
    row_id: str,
    vector: str,
    c: int = 3,
    m: float = 2.0,
    error: float = 0.005,
    max_rounds: int = 1000,
    seed: int = 42,
    start: Centres | None = None,
) -> Centres:
    """Centres of fuzzy c-means; stops when the memberships change by less than ``error`` in norm.

    Starts from given centres or from seeded rows. One scan per round: it takes the new centres
    and, from the two last sets of centres, the change of the memberships, which are not stored.
    """
    if start is None:
        seeds = df.select(vector, shuffle_key(row_id, seed).alias("_h"))
        start = [list(r[0]) for r in seeds.orderBy("_h").limit(c).collect()]
    rows = df.select(vector, array_to_vector(vector).alias("_v")).persist()
    now, before = start, None
    try:
        for _ in range(max_rounds):
            after, change = _fuzzy_round(rows, vector, now, before, m)
            if change < error * error:
                break
            before, now = now, after
    finally:
        rows.unpersist()
    return now


def with_memberships(df: DataFrame, vector: str, centres: Centres, m: float = 2.0) -> DataFrame:
    """Add the membership array and the cluster with the highest one, the lowest on ties."""
    c = range(len(centres))
    weighed = df.selectExpr("*", *_weights(centres, vector, "_w", m))
    weighed = weighed.selectExpr("*", f"{' + '.join(f'_w{j}' for j in c)} AS _w")
    shares = F.array(*[F.col(f"_w{j}") / F.col("_w") for j in c])
    out = weighed.withColumn("membership", shares).drop("_w", *[f"_w{j}" for j in c])
    best = F.array_position("membership", F.array_max("membership")) - 1
    return out.withColumn("cluster", best.cast("int"))


# --- subtractive clustering ---------------------------------------------------------------------


def min_max_vectors(df: DataFrame, vector: str, target: str, epsilon: float = 1e-10) -> DataFrame:
    """Scale every dimension to [0, 1], with a small addition to the denominator."""
    v = array_to_vector(vector)
    low, high = _as_lists(df.agg(Summarizer.min(v), Summarizer.max(v)).first())
    lows = F.array(*[F.lit(x) for x in low])
    spans = F.array(*[F.lit(b - a + epsilon) for a, b in zip(low, high)])
    scaled = F.zip_with(F.zip_with(vector, lows, lambda x, a: x - a), spans, lambda x, s: x / s)
    return df.withColumn(target, scaled)


def influence_radius(df: DataFrame, vector: str) -> float:
    """Half the 75th percentile of the vector norms."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    q = exact_quantiles(df.select(norm.alias("norm")), ["norm"], [0.75])
    return q.first()["value"] / 2


@dataclass(frozen=True)
class Balls:
    """Pivots with the radius of the ball that holds the points nearest to each."""

    pivots: Centres
    radius: list[float]


def _with_ball(df: DataFrame, pivots: Centres) -> DataFrame:
    """Add the nearest pivot (``cell``) and the distance to it (``gap``) for vectors in ``v``."""
    fields = [StructField("cell", IntegerType()), StructField("gap", DoubleType())]
    schema = StructType(df.schema.fields + fields)

    def run(batches):
        p = np.asarray(pivots, dtype=float)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf["v"].to_numpy())
            cell, gap = np.empty(len(x), dtype=np.int32), np.empty(len(x))
            for a in range(0, len(x), 128):
                d = np.sqrt(((x[a : a + 128, None, :] - p[None, :, :]) ** 2).sum(axis=2))
                cell[a : a + 128] = d.argmin(axis=1)
                gap[a : a + 128] = d.min(axis=1)
            yield pdf.assign(cell=cell, gap=gap)

    return df.mapInPandas(run, schema)


def build_balls(points: DataFrame) -> tuple[Balls, DataFrame]:
    """Choose pivots among the points by hash and assign the points; about sqrt(n) / 2 balls."""
    points = cut_lineage(points)
    m = max(1, min(BALLS, ceil(sqrt(points.count()) / 2)))
    chosen = points.select("v").orderBy(F.xxhash64("v", F.lit(42)), "v").limit(m).collect()
    pivots = [list(r["v"]) for r in chosen]
    placed = cut_lineage(_with_ball(points, pivots))
    radius = [0.0] * len(pivots)
    for row in placed.groupBy("cell").agg(F.max("gap").alias("r")).collect():
        radius[row["cell"]] = row["r"]
    return Balls(pivots, radius), placed


def _with_density_bound(points: DataFrame, pivots: Centres, reach, weight, radius: float):
    """Upper bound on the density of a point, from the distance to each cell's ball."""

    def run(batches):
        p, r, w = (np.asarray(a, dtype=float) for a in (pivots, reach, weight))
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf["v"].to_numpy())
            bound = np.empty(len(x))
            for a in range(0, len(x), 128):
                d = np.sqrt(((x[a : a + 128, None, :] - p[None, :, :]) ** 2).sum(axis=2))
                gap = np.maximum(0.0, d - r[None, :] - 1e-12)
                bound[a : a + 128] = (w[None, :] * np.exp(-(gap**2) / radius**2)).sum(axis=1)
            yield pdf.assign(bound=bound * (1 + 1e-12))

    schema = "v array<double>, pid " + dict(points.dtypes)["pid"] + ", weight bigint, bound double"
    return points.select("v", "pid", "weight").mapInPandas(run, schema)


def _densities_in_packs(radius: float):
    """For every point of the task's packs what the others of these packs add to its density at most."""

    def run(pairs):
        import pyarrow as pa

        ids, totals = {}, {}
        for a, b in pairs:
            for side in (a, b):
                if side.number not in totals:
                    ids[side.number], totals[side.number] = side["pid"].copy(), np.zeros(len(side.x))
            product = packs.Product(a.x, b.x)
            if product.single and product.slack(0.0) > 1e-3 * radius**2:
                product = product.double()
            w, u = b["weight"].astype(product.kind), a["weight"].astype(product.kind)
            slack, scale = product.kind(product.slack(0.0)), product.kind(-1.0 / radius**2 if radius else -np.inf)
            for at in range(0, len(a.x), packs.TILE):
                near = np.exp(scale * np.maximum(product.tile(at) - slack, 0))
                rows = slice(at, at + len(near))
                totals[a.number][rows] += near @ w
                if a.number != b.number:
                    totals[b.number] += u[rows] @ near
        for number, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array(ids[number]), pa.array(total)], names=["pid", "s"])

    return run


def _with_pair_bound(points: DataFrame, radius: float) -> DataFrame:
    """Upper bounds on the densities from all pairs of points, above them by no more than what single precision leaves open."""
    rows = points.select("v", "pid", "weight")
    numbered = cut_lineage(rows.withColumnRenamed("pid", "_id").withColumn("pid", F.monotonically_increasing_id()))
    table = packs.packs(build_tree(numbered)[1].drop("reach"), ["pid", "weight"], neighbours.BLOCK, PAIRED)
    sums = packs.meet(table, table, _densities_in_packs(radius), "pid long, s double", packs.each_once())
    bound = sums.groupBy("pid").agg((F.sum("s") * (1 + 1e-3)).alias("bound"))
    return numbered.join(bound, "pid").select("v", F.col("_id").alias("pid"), "weight", "bound")


def _densities(points: DataFrame, vectors: Centres, radius: float) -> list[float]:
    """Exact densities of a bounded batch of vectors in one scan with partial sums per batch."""

    def run(batches):
        import pandas as pd

        c = np.asarray(vectors, dtype=float)
        total = np.zeros(len(c))
        for pdf in batches:
            x, w = np.stack(pdf["v"].to_numpy()), pdf["weight"].to_numpy()
            for a in range(0, len(x), 128):
                d2 = ((x[a : a + 128, None, :] - c[None, :, :]) ** 2).sum(axis=2)
                total += w[a : a + 128] @ np.exp(-d2 / radius**2)
        yield pd.DataFrame({"i": np.arange(len(c), dtype=np.int32), "s": total})

    sums = points.select("v", "weight").mapInPandas(run, "i int, s double")
    rows = sums.groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = [0.0] * len(vectors)
    for r in rows:
        out[r["i"]] = r["s"]
    return out


def subtractive_centres(
    df: DataFrame, row_id: str, vector: str, k: int = 3, share: float = 0.15
) -> Centres:
    """At most ``k`` dense points as centres, of vectors already scaled to [0, 1].

    The density of a point is the sum of ``exp(-d² / r²)`` over all rows. The densest point is the
    first centre; each further one is the densest at least ``r / 2`` away from the centres before,
    if its density exceeds ``share`` of the highest. Instead of all pairs, points are taken in
    order of an upper bound (from the balls around a bounded number of cells), and exact densities
    are computed batch by batch until no remaining bound can win. In many dimensions all balls overlap and their bounds rule out
    nearly nobody; after ``LOOSE`` batches bounds come from all pairs, in packs. The result is exact.
    """
    radius = influence_radius(df, vector)
    points = cut_lineage(distinct_vectors(df, row_id, vector))
    cells, placed = build_balls(points)
    weight = [0] * len(cells.pivots)
    for r in placed.groupBy("cell").agg(F.sum("weight").alias("w")).collect():
        weight[r["cell"]] = r["w"]
    bounded = cut_lineage(
        _with_density_bound(points, cells.pivots, cells.radius, weight, radius)
    )
    centres: Centres = []
    judged: list[tuple[float, object, list[float]]] = []
    last, top, batches = None, None, 0

    def free(v):
        return all(sqrt(sum((a - b) ** 2 for a, b in zip(v, c))) >= radius * 0.5 for c in centres)

    while len(centres) < k:
        best = max(
            (j for j in judged if free(j[2])), key=lambda j: j[0], default=None
        )
        todo = bounded
        if last is not None:
            b, p = last
            todo = todo.where(
                (F.col("bound") < b) | ((F.col("bound") == b) & (F.col("pid") > F.lit(p)))
            )
        if best is not None:
            todo = todo.where(F.col("bound") >= best[0])
        if top is not None:
            todo = todo.where(F.col("bound") > top * share)
        for c in centres:
            near = centre_distances(F.col("v"), [c])[0]
            todo = todo.where(F.sqrt(near) >= radius * 0.5)
        batch = todo.orderBy(F.col("bound").desc(), "pid").limit(CANDIDATES).collect()
        if batch:
            vectors = [list(r["v"]) for r in batch]
            for r, v, density in zip(batch, vectors, _densities(points, vectors, radius)):
                judged.append((density, r["pid"], v))
            judged.sort(key=lambda j: (-j[0], j[1]))
            last = (batch[-1]["bound"], batch[-1]["pid"])
            batches += 1
            if batches == LOOSE and len(batch) == CANDIDATES and points.count() <= neighbours.MANY:
                bounded, last = cut_lineage(_with_pair_bound(points, radius)), None
                judged.clear()
            continue
        if best is None or (top is not None and best[0] <= top * share):
            break
        top = best[0] if top is None else top
        centres.append(best[2])
    return centres


def subtractive(df: DataFrame, row_id: str, vector: str, k: int = 3) -> DataFrame:
    """Add the nearest subtractive centre of each row as ``cluster``."""
    scaled = min_max_vectors(df, vector, "_scaled")
    centres = subtractive_centres(scaled, row_id, "_scaled", k)
    return assign(scaled, "_scaled", centres).drop("_scaled")


# --- Ward ---------------------------------------------------------------------------------------


def _cheapest_in_block(q, p):
    """The cheapest merge of each query group with another group of the block; ties by the other's id."""
    import pandas as pd

    if len(q) == 0 or len(p) == 0:
        return pd.DataFrame()
    p = p.sort_values("pid", kind="stable")
    y, m, ids = np.stack(p["v"].to_numpy()), p["weight"].to_numpy(float), p["pid"].to_numpy()
    out = []
    for a in range(0, len(q), 32):
        part = q.iloc[a : a + 32]
        x, n = np.stack(part["v"].to_numpy()), part["weight"].to_numpy(float)
        cost = ((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2) * (np.outer(n, m) / np.add.outer(n, m))
        cost[part["pid"].to_numpy()[:, None] == ids[None, :]] = np.inf
        best = cost.argmin(axis=1)
        found = pd.DataFrame({"pid": part["pid"].to_numpy(), "nid": ids[best], "cost": cost.min(axis=1)})
        out.append(found[np.isfinite(found["cost"])])
    return pd.concat(out)


def _merge_reach(part, radius, least):
    """How far a group may lie whose merge costs at most ``bound``: with d² n m / (n + m) for sizes n and m >= least."""
    n, bound = (part[c].to_numpy(float)[:, None] for c in ("weight", "bound"))
    return np.sqrt(bound * (1.0 / n + 1.0 / least[None, :])) * (1 + 1e-9)


def cheapest_partners(asked: DataFrame, groups: DataFrame) -> DataFrame:
    """(pid, nid, cost): for each asked group the other group whose merge adds least to the inner variance.

    Both have (pid, v, weight): the group's smallest id, its mean and its size.
    """
    id_type = dict(groups.dtypes)["pid"]
    schema = f"pid {id_type}, nid {id_type}, cost double"
    asked = asked.select("pid", "v", "weight")
    tree, placed = build_tree(groups.select("pid", "v", "weight"))
    if placed.count() <= neighbours.MANY:
        return cheapest_merges(placed.join(asked.select("pid"), "pid", "left_semi").drop("reach"), placed.drop("reach"), 1)
    at_home = cut_lineage(tree.home(asked, 1)).withColumnRenamed("cell", "visit")
    near = block_join(at_home, placed, _cheapest_in_block, schema).groupBy("pid").agg(F.min("cost").alias("bound"))
    bounded = asked.join(near, "pid", "left").fillna(float("inf"), ["bound"])
    visiting = cut_lineage(tree.visits(bounded, step=near_children(_merge_reach)))
    found = block_join(visiting, placed, _cheapest_in_block, schema)
    best = F.min(F.struct("cost", "nid")).alias("_m")
    return found.groupBy("pid").agg(best).select("pid", "_m.nid", "_m.cost")


def _cheapest_in_packs(k: int):
    def run(pairs):
        import pyarrow as pa

        def results():
            if best is None or best.ids is None:
                return
            pid, nid, cost = np.repeat(asked["pid"], best.found.sum(axis=1)), best.ids[best.found], best.d[best.found]
            columns = [pa.array(pid, from_pandas=True), pa.array(nid, from_pandas=True), pa.array(cost)]
            yield pa.RecordBatch.from_arrays(columns, names=["pid", "nid", "cost"])

        asked, best = None, None
        for a, b in pairs:
            if a is not asked:
                yield from results()
                asked, best, n = a, packs.Nearest(len(a.x), k), a["weight"].astype(float)
            m = b["weight"].astype(float)
            limits = best.limits()
            gap = np.sqrt(((a.x - b.middle) ** 2).sum(axis=1))
            apart = np.maximum(gap - b.radius, 0.0) ** 2 * (1 - 1e-9) / (1.0 / n + 1.0 / m.min())
            rows = np.flatnonzero(~(apart > limits))
            if not len(rows):
                continue
            product = packs.Product(a.x[rows], b.x)
            for at in range(0, len(rows), packs.TILE):
                # A group itself is among its cheapest and goes.
                r, c = packs.cheapest(product, at, n[rows], m, limits[rows], k + 1)
                other = a["pid"][rows[at + r]] != b["pid"][c]
                r, c = r[other], c[other]
                cost = packs.costs(product.x, b.x, n[rows], m, at + r, c)
                best.add(rows[at + r], cost, b["pid"][c])
        yield from results()

    return run


def _merge_far(k: int):
    """How far a pack's groups have to look for their ``k`` cheapest merges, from those inside the pack; sizes are 1 at least."""

    def far(x, columns):
        n = columns["weight"].astype(float)
        if len(x) <= k:
            return np.full(len(x), np.nan)
        product, out = packs.Product(x, x, single=False), np.empty(len(x))
        for a in range(0, len(x), packs.TILE):
            size = n[a : a + packs.TILE, None]
            most = (product.tile(a) + product.slack(0.0)) * (size * n / (size + n)) * (1 + 1e-9)
            out[a : a + packs.TILE] = np.sqrt(np.partition(most, k, axis=1)[:, k] * (1.0 / size[:, 0] + 1.0))
        return out * (1 + 1e-9)

    return far


def cheapest_merges(asked: DataFrame, groups: DataFrame, k: int) -> DataFrame:
    """(pid, nid, cost): for each asked group the ``k`` other groups whose merges add least to the inner variance.

    Both have (pid, v, weight, cell), asked groups being among ``groups``.
    """
    id_type = dict(groups.dtypes)["pid"]
    left = packs.packs(asked, ["pid", "weight"], neighbours.BLOCK, neighbours.ASKED, _merge_far(k))
    right = packs.packs(groups, ["pid", "weight"], neighbours.BLOCK, neighbours.POOL)
    found = packs.meet(left, right, _cheapest_in_packs(k), f"pid {id_type}, nid {id_type}, cost double")
    # The dearest of k from any task bounds the k cheapest of all.
    first = F.array_sort(F.collect_list(F.struct("cost", "nid")))
    return found.groupBy("pid").agg(F.slice(first, 1, k).alias("m")).select("pid", F.inline("m")).select("pid", "nid", "cost")


def _certain_merges(batches):
    """The merges that the cheapest merges of each group settle, and the groups they leave.

    A group that is not among a group's listed partners costs at least its dearest listed one, its bound. This stays so when groups
    merge, as a merged group is no cheaper than the cheaper one of its parts was. A partner listed for a part is one of the whole; with a
    group of r rows that is listed for neither part, the whole costs ((n + r) A + (m + r) B - r c) / (n + m + r) by the formula of Lance and
    Williams, where c is the cost of the merge and A and B are at least the bounds of the parts: least for the smallest r or the
    largest. So a group knows its cheapest partner as long as that costs no more than its bound, and partners that choose
    each other merge. Rounds end when nobody can.
    """
    import pandas as pd

    parts = [pdf for pdf in batches if len(pdf)]
    if not parts:
        return
    rows = pd.concat(parts).sort_values("pid", kind="stable", ignore_index=True)
    ids, x, n = rows["pid"].to_numpy(), np.stack(rows["v"].to_numpy()), rows["weight"].to_numpy(float)
    bound = rows["bound"].to_numpy(float, na_value=np.inf).copy()
    partners = [p if p is not None else [] for p in rows["partners"]]
    owner = np.repeat(np.arange(len(ids)), [len(p) for p in partners])
    places = np.flatnonzero(~pd.Index(ids).duplicated())
    other = places[pd.Index(ids[places]).get_indexer(np.concatenate(partners))] if len(owner) else owner
    del rows, parts, partners
    root, merges = np.arange(len(ids)), []
    cost = packs.costs(x, x, n, n, owner, other)
    while len(owner):
        order = np.lexsort((other, cost, owner))
        first = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]
        sure = first[cost[first] <= bound[owner[first]]]
        choice = np.full(len(ids), -1)
        choice[owner[sure]] = other[sure]
        i = owner[sure][(choice[other[sure]] == owner[sure]) & (owner[sure] < other[sure])]
        if not len(i):
            break
        j = choice[i]
        dear, total = packs.costs(x, x, n, n, i, j), n[i] + n[j]
        merges.append(pd.DataFrame({"a": ids[i], "b": ids[j], "cost": dear, "size": total.astype(np.int64)}))
        both, r = bound[i] + bound[j] - dear, n[root == np.arange(len(ids))].min()
        least = (n[i] * bound[i] + n[j] * bound[j] + r * both) / (total + r)
        x[i] = (x[i] * n[i, None] + x[j] * n[j, None]) / total[:, None]
        n[i], root[j], bound[i] = total, i, np.minimum(least, both) * (1 - 1e-12)
        new = np.zeros(len(ids), bool)
        new[i] = True
        owner, other = root[owner], root[other]
        stale = new[owner] | new[other]
        pair = np.unique(owner[stale] * len(ids) + other[stale])
        again = np.divmod(pair[pair // len(ids) != pair % len(ids)], len(ids))
        owner, other = np.concatenate([owner[~stale], again[0]]), np.concatenate([other[~stale], again[1]])
        cost = np.concatenate([cost[~stale], packs.costs(x, x, n, n, *again)])
    left = np.flatnonzero(root == np.arange(len(ids)))
    for a in range(0, len(left), 10_000):
        some = left[a : a + 10_000]
        kept = pd.DataFrame({"pid": ids[some], "v": list(x[some]), "weight": n[some].astype(np.int64)})
        yield kept.assign(a=None, b=None, cost=None, size=None)
    for made in merges:
        yield made.assign(pid=None, v=None, weight=None)[["pid", "v", "weight", "a", "b", "cost", "size"]]


def _last_merges(batches):
    """The merges of the groups of one block, the cheapest first."""
    import pandas as pd

    parts = [pdf for pdf in batches if len(pdf)]
    if not parts:
        return
    rows = pd.concat(parts).sort_values("pid", kind="stable")
    ids, x, n = rows["pid"].tolist(), np.stack(rows["v"].to_numpy()), rows["weight"].to_numpy(float)

    def costs(i):
        out = ((x - x[i]) ** 2).sum(axis=1) * (n * n[i] / (n + n[i]))
        out[gone] = np.inf
        out[i] = np.inf
        return out

    gone = np.zeros(len(ids), bool)
    cost = np.stack([costs(i) for i in range(len(ids))])
    best, out = cost.argmin(axis=1), []
    for _ in range(len(ids) - 1):
        least = cost[np.arange(len(ids)), best]
        i = int(least.argmin())
        i, j = sorted((i, int(best[i])))
        total = n[i] + n[j]
        out.append((ids[i], ids[j], float(cost[i, j]), int(total)))
        x[i] = (x[i] * n[i] + x[j] * n[j]) / total
        n[i] = total
        gone[j] = True
        cost[j], cost[:, j] = np.inf, np.inf
        cost[i] = cost[:, i] = costs(i)
        # Merging others never makes a new group the cheaper partner: only those that had i or j look again.
        for r in np.flatnonzero(((best == i) | (best == j)) & ~gone).tolist() + [i, j]:
            best[r] = cost[r].argmin()
    yield pd.DataFrame(out, columns=["a", "b", "cost", "size"])


def ward_merges(points: DataFrame) -> DataFrame:
    """(a, b, cost, size) of every merge of the Ward hierarchy over (pid, v, weight), one less than points.

    Rounds of reciprocal partners: every group knows the group it merges with most cheaply, and all pairs that choose each
    other merge at once. Merging others never makes a partner dearer than a new group, so a group looks
    for a partner again only when its own has merged. Groups whose means take at most ``MERGED`` bytes look for their
    ``PARTNERS`` cheapest merges at once, with which a task goes on for as many rounds as these settle. Groups that have become few
    enough for one block of a block join are merged to the end in a task. ``a`` and ``b`` are the smallest ids of the merged groups.
    """
    groups = cut_lineage(points.select("pid", "v", "weight"))
    id_type = dict(groups.dtypes)["pid"]
    known: DataFrame | None = None
    merges: DataFrame | None = None
    n = groups.count()
    width = 8 * (groups.agg(F.max(F.size("v"))).first()[0] or 0)
    while n > neighbours.BLOCK and n * width <= MERGED:
        tree_cells = build_tree(groups.select("pid", "v", "weight"))[1]
        found = cheapest_merges(tree_cells, tree_cells, PARTNERS)
        # Lists that hold all others bound nothing.
        listed = found.groupBy("pid").agg(
            F.collect_list("nid").alias("partners"), F.when(F.count(F.lit(1)) >= PARTNERS, F.max("cost")).alias("bound")
        )
        rows = groups.join(listed, "pid", "left").select("pid", "v", "weight", "partners", "bound")
        schema = f"pid {id_type}, v array<double>, weight long, a {id_type}, b {id_type}, cost double, size long"
        done = cut_lineage(rows.coalesce(1).mapInPandas(_certain_merges, schema))
        groups = done.where("v IS NOT NULL").select("pid", "v", "weight")
        new = done.where("v IS NULL").select("a", "b", "cost", "size")
        merges = new if merges is None else merges.unionByName(new)
        before, n = n, groups.count()
        if n == before:
            break
    while n > neighbours.BLOCK:
        asked = groups if known is None else groups.join(known, "pid", "left_anti")
        found = cheapest_partners(asked, groups)
        # Unions add up partitions round by round, so both tables are dealt out anew.
        known = rewritten((found if known is None else found.unionByName(known)).repartition("pid"), "partners")
        other = known.select(F.col("pid").alias("nid"), F.col("nid").alias("pid"))
        mutual = known.join(other, ["pid", "nid"]).where("pid < nid")
        sides = [groups.select(F.col("pid").alias(p), F.col("v").alias(f"v_{p}"), F.col("weight").alias(f"w_{p}")) for p in ("pid", "nid")]
        pairs = rewritten(mutual.join(sides[0], "pid").join(sides[1], "nid"), "merges")
        n -= pairs.count()
        size = F.col("w_pid") + F.col("w_nid")
        mean = F.zip_with("v_pid", "v_nid", lambda x, y: (x * F.col("w_pid") + y * F.col("w_nid")) / size)
        gone = pairs.select(F.explode(F.array("pid", "nid")).alias("pid"))
        merged = pairs.select("pid", mean.alias("v"), size.alias("weight"))
        groups = rewritten(groups.join(gone, "pid", "left_anti").unionByName(merged).repartition("pid"), "groups")
        known = known.join(gone, "pid", "left_anti").join(gone.withColumnRenamed("pid", "nid"), "nid", "left_anti")
        known = known.select("pid", "nid", "cost")
        new = pairs.select(F.col("pid").alias("a"), F.col("nid").alias("b"), "cost", size.alias("size"))
        merges = new if merges is None else merges.unionByName(new)
    last = groups.coalesce(1).mapInPandas(_last_merges, f"a {id_type}, b {id_type}, cost double, size long")
    return last if merges is None else merges.unionByName(last)


def ward(df: DataFrame, row_id: str, vector: str, k: int = 3) -> DataFrame:
    """Add the ``k`` Ward clusters, numbered by size, the largest first, then by smallest row id.

    The whole hierarchy is made by ``ward_merges``; without its k - 1 dearest merges the others join rows into the clusters.
    Only numbers of clusters reach the driver. Fewer than ``k`` distinct vectors are a cluster each.
    """
    points = cut_lineage(distinct_vectors(df, row_id, vector))
    merges = cut_lineage(ward_merges(points))
    dearest = merges.orderBy(F.col("cost").desc(), F.col("size").desc(), "a", "b").limit(k - 1)
    edges = merges.join(F.broadcast(dearest.select("a", "b")), ["a", "b"], "left_anti").select("a", "b")
    member = points.join(connected_components(edges), F.col("pid") == F.col("node"), "left")
    member = cut_lineage(member.select("v", "weight", "pid", F.coalesce("component", "pid").alias("root")))
    sizes = member.groupBy("root").agg(F.sum("weight").alias("_n"))  # at most k rows
    number = F.row_number().over(W.orderBy(F.col("_n").desc(), "root")) - 1
    placed = member.join(F.broadcast(sizes.select("root", number.alias("cluster"))), "root")
    return attach_by_key(df, placed.select(F.col("v").alias(vector), "cluster", "weight"), [vector], "weight").drop("weight")


# --- all of them --------------------------------------------------------------------------------


def all_clusterings(
    df: DataFrame, row_id: str, vector: str, k: int = 3, restarts: int = 10, seed: int = 42
) -> DataFrame:
    """Long table (row id, algorithm, cluster) of the five algorithms over one vector column."""
    base = cut_lineage(df.select(row_id, vector))
    centres, _ = kmeans(base, vector, k, restarts, seed)
    fuzzy = fuzzy_cmeans(base, row_id, vector, k, seed=seed)
    eps = adaptive_eps(base, row_id, vector, 5, 0.9, "linear").first()["eps"]
    found = {
        "KMeans": assign(base, vector, centres),
        "Fuzzy_CMeans": with_memberships(base, vector, fuzzy),
        "Subtractive": subtractive(base, row_id, vector, k),
        "DBSCAN": reassign_noise(dbscan(base, row_id, vector, eps, 5), vector),
        "Hierarchical": ward(base, row_id, vector, k),
    }
    out = None
    for name, table in found.items():
        part = table.select(row_id, F.lit(name).alias("algorithm"), F.col("cluster").cast("int"))
        out = part if out is None else out.unionByName(part)
    return out
