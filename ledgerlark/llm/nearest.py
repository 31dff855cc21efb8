"""Nearest neighbours by inner product: multiprobe p-stable hashing and exact distance reranking.

Vectors get one more component, so that the largest inner product becomes the smallest Euclidean
distance. Each of ``tables`` hash functions projects onto ``bits`` Gaussian directions, cut into
cells of one width. A query visits the cells around its own in the order of their estimated success:
the product over the directions of the probability that a Gaussian step of a neighbour's size ends in the cell.

The cell width, the expected neighbour distance and the number of cells to visit are fitted on a
bounded sample: ``sample`` queries (the first by the hash of their id) are compared with all
rows, and the shortest probe list that finds ``target`` of their true neighbours is taken.

Rows of one cell meet the queries that visit it in a task. Cells with more than ``cell`` rows are cut
into pieces, and a task gets at most about that many rows; if very many queries visit it, its rows
are copied so that they share the queries. Candidates are compared by their exact inner product in double
precision. Equal vectors are searched once, with the smallest of their ids, as many as can be asked for.

Vectors that are NULL, zero, hold NULL or non-finite components or have another length than most take
no part, nor do rows without id. Rows equal in id and vector count once. An empty table gives an
empty one, a table with fewer candidates than asked for gives them all; other columns play no part.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.llm.common import read
from ledgerlark.llm.registry import query
from ledgerlark.session import cut_lineage

TABLES, BITS, STEPS = 2, 4, 2
SAMPLE, TARGET = 128, 0.96
CELL = 8192
#: More visiting queries than this share a task's rows with a copy of them.
VISITORS = 50_000
SEED = 20


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    good = (
        F.col(id_col).isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
        & F.exists(v, lambda x: x != 0)
    )
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(good)
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (size[0]["d"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


class Hashing:
    """The hash functions and the order in which a query's cells are visited."""

    def __init__(self, dim: int, norm: float, near: float, tables: int, bits: int, steps: int):
        rng = np.random.default_rng(SEED)
        if not 1 <= bits <= 5:
            raise ValueError("cells are numbered with 12 binary digits for each of 1 to 5 directions")
        self.norm, self.near, self.width = norm, near, near
        self.dirs = rng.standard_normal((tables, dim + 1, bits))
        self.shift = rng.random((tables, bits)) * self.width
        self.steps = np.array(list(itertools.product(range(-steps, steps + 1), repeat=bits)))
        grid = np.linspace(-9, 9, 3601)
        self._grid, self._cdf = grid, np.array([0.5 * (1 + math.erf(z / math.sqrt(2))) for z in grid])

    def place(self, v: np.ndarray, table: int, is_query: bool) -> np.ndarray:
        """Positions on the directions, in cell widths."""
        size = np.sqrt((v * v).sum(axis=1, keepdims=True))
        if is_query:
            v, last = v * (self.norm / size), np.zeros_like(size)
        else:
            last = np.sqrt(np.maximum(self.norm**2 - size**2, 0))
        return (np.hstack([v, last]) @ self.dirs[table] + self.shift[table]) / self.width

    @staticmethod
    def number(cells: np.ndarray) -> np.ndarray:
        """One number per cell."""
        out = np.zeros(cells.shape[:-1], np.int64)
        for k in range(cells.shape[-1]):
            out = out * 4096 + (np.clip(cells[..., k], -2048, 2047).astype(np.int64) + 2048)
        return out

    def probes(self, v: np.ndarray, table: int, most: int) -> np.ndarray:
        """Numbers of the ``most`` likeliest cells of each query, the likeliest first."""
        at = self.place(v, table, True)
        cell = np.floor(at)
        inside = at - cell
        chance = np.zeros((len(v), len(self.steps)))
        for k in range(at.shape[1]):
            z = self.width / self.near
            per = {
                s: np.log(
                    np.interp((s + 1 - inside[:, k]) * z, self._grid, self._cdf)
                    - np.interp((s - inside[:, k]) * z, self._grid, self._cdf)
                    + 1e-300
                )
                for s in np.unique(self.steps[:, k])
            }
            chance += np.stack([per[s] for s in self.steps[:, k]], axis=1)
        order = np.argsort(-chance, axis=1, kind="stable")[:, :most]
        return self.number(cell[:, None, :] + self.steps[order])


def _sample_neighbours(vectors: DataFrame, some: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """The k nearest other vectors of each sample query, by comparing it with all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_s = np.full((len(some), k), -np.inf)
        best_v = np.zeros((len(some), k, some.shape[1]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                gid, v = part.column(0).to_numpy(), _matrix(part.column(1))
                score = some @ v.T
                score[own[:, None] == gid[None, :]] = -np.inf
                for q in range(len(some)):
                    top = np.argsort(-score[q])[:k]
                    top = top[score[q][top] > best_s[q, -1]]
                    if len(top):
                        s, vv = np.concatenate([best_s[q], score[q][top]]), np.concatenate([best_v[q], v[top]])
                        order = np.argsort(-s)[:k]
                        best_s[q], best_v[q] = s[order], vv[order]
        q, i = np.nonzero(np.isfinite(best_s))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(best_s[q, i]), pa.array(list(best_v[q, i]), pa.list_(pa.float64()))],
            names=["q", "s", "v"],
        )

    found = vectors.select("gid", "v").mapInArrow(run, "q long, s double, v array<double>")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("s")))
    rows = found.withColumn("n", rank).where(F.col("n") <= k).select("q", "v").collect()  # at most sample * k rows
    out = [[] for _ in some]
    for r in rows:
        out[r["q"]].append(r["v"])
    return [np.array(x, np.float64).reshape(len(x), some.shape[1]) for x in out]


def fit(vectors: DataFrame, queries: DataFrame, k: int, tables: int, bits: int, steps: int, sample: int, target: float):
    """(hashing, number of probes) from the sample, or None if there is no query or no vector."""
    norm = vectors.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).collect()[0][0]
    rows = queries.orderBy(F.xxhash64("gid"), "gid").limit(sample).collect()
    if not rows or norm is None:
        return None
    some, own = np.array([r["v"] for r in rows]), np.array([r["gid"] for r in rows])
    true = _sample_neighbours(vectors, some, own, k)
    scaled = some * (norm / np.sqrt((some * some).sum(axis=1, keepdims=True)))
    far = [
        np.sqrt(np.maximum(2 * norm**2 - 2 * (v @ s), 0))
        for s, v in zip(scaled, true, strict=True)
        if len(v)
    ]
    near = float(np.median(np.concatenate(far))) if far else norm
    hashing = Hashing(some.shape[1], norm, max(near, 1e-6 * norm), tables, bits, steps)
    rank = [np.full(len(v), len(hashing.steps)) for v in true]
    for t in range(tables):
        order = hashing.probes(some, t, len(hashing.steps))
        for q, v in enumerate(true):
            if len(v):
                cells = hashing.number(np.floor(hashing.place(v, t, False)))
                hit = order[q][None, :] == cells[:, None]
                rank[q] = np.minimum(rank[q], np.where(hit.any(axis=1), hit.argmax(axis=1), len(hashing.steps)))
    flat = np.sort(np.concatenate(rank))
    probes = int(flat[min(len(flat) - 1, math.ceil(target * len(flat)))]) + 1 if len(flat) else 1
    return hashing, min(probes, len(hashing.steps))


def _cells(df: DataFrame, hashing: Hashing, tables: int) -> DataFrame:
    """(gid, v, tab, cell): one row per vector and table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(1))
                for t in range(tables):
                    cell = hashing.number(np.floor(hashing.place(v, t, False)))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(np.full(len(v), t, np.int32)), pa.array(cell)],
                        names=["gid", "v", "tab", "cell"],
                    )

    return df.select("gid", "v").mapInArrow(run, "gid long, v array<double>, tab int, cell long")


def _visits(df: DataFrame, hashing: Hashing, tables: int, probes: int) -> DataFrame:
    """(gid, tab, cell): the cells that each query visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                v, gid = _matrix(batch.column(1)), batch.column(0).to_numpy()
                for t in range(tables):
                    cells = hashing.probes(v, t, probes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(gid, cells.shape[1])),
                            pa.array(np.full(cells.size, t, np.int32)),
                            pa.array(cells.ravel()),
                        ],
                        names=["gid", "tab", "cell"],
                    )

    return df.select("gid", "v").mapInArrow(run, "gid long, tab int, cell long")


def _meet(k: int):
    """Over rows sorted by (task, copy, kind): vectors with their cell, then queries with the cells they visit."""

    def solve(gid, v, cell, q_gid, q_v, q_cells) -> pa.RecordBatch:
        order = np.argsort(cell, kind="stable")
        gid, v, cell = gid[order], v[order], cell[order]
        best_s = np.full((len(q_gid), k), -np.inf)
        best_i = np.zeros((len(q_gid), k), np.int64)
        who = np.repeat(np.arange(len(q_gid)), [len(c) for c in q_cells])
        wanted = np.concatenate([np.asarray(c, np.int64) for c in q_cells])
        by_cell = np.argsort(wanted, kind="stable")
        who, wanted = who[by_cell], wanted[by_cell]
        cells, first = np.unique(wanted, return_index=True)
        for c, a, b in zip(cells, first, np.append(first[1:], len(wanted)), strict=True):
            lo, hi = np.searchsorted(cell, c), np.searchsorted(cell, c, side="right")
            for q0 in range(a, b if hi > lo else a, 1024):
                q = who[q0 : min(b, q0 + 1024)]
                score = q_v[q] @ v[lo:hi].T
                s = np.hstack([best_s[q], score])
                i = np.hstack([best_i[q], np.broadcast_to(np.arange(lo, hi), score.shape)])
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                best_s[q], best_i[q] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
        q, j = np.nonzero(np.isfinite(best_s))
        i = best_i[q, j]
        exact = (q_v[q] * v[i]).sum(axis=1)  # in one order of summation wherever the pair meets
        return pa.RecordBatch.from_arrays([pa.array(q_gid[q]), pa.array(gid[i]), pa.array(exact)], names=["q", "gid", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for whole in batches:
            task, copy, kind = (whole.column(c).to_numpy() for c in (0, 1, 2))
            if not len(task):
                continue
            edge = np.flatnonzero((np.diff(task) != 0) | (np.diff(copy) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *edge], [*edge, len(task)], strict=True):
                part = whole.slice(int(lo), int(hi - lo))
                if at != (task[lo], copy[lo]):
                    at, held = (task[lo], copy[lo]), []
                if kind[lo] == 0:
                    cells = part.column(5).flatten().to_numpy(zero_copy_only=False)
                    held.append((part.column(3).to_numpy(), _matrix(part.column(4)), cells))
                elif held:
                    held = [tuple(np.concatenate(x) for x in zip(*held, strict=True))]
                    yield solve(*held[0], part.column(3).to_numpy(), _matrix(part.column(4)), part.column(5).to_pylist())

    return run


def search(
    df: DataFrame, is_query: Column, k: int = 20, tables: int = TABLES, bits: int = BITS, steps: int = STEPS,
    sample: int = SAMPLE, target: float = TARGET, cell: int = CELL, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every query row, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = df.sparkSession
    rows = cut_lineage(usable(df, id_col, vec_col).distinct())
    ranked = rows.withColumn("n", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    vectors = ranked.groupBy("v").agg(F.collect_list("vec_id").alias("ids"))
    vectors = cut_lineage(vectors.withColumn("gid", F.monotonically_increasing_id()).select("gid", "v", "ids"))
    asked = cut_lineage(rows.where(is_query).join(vectors.select("gid", "v"), "v").select(F.col("vec_id").alias("query_id"), "gid"))
    queries = cut_lineage(vectors.join(asked.select("gid").distinct(), "gid", "left_semi").select("gid", "v"))
    fitted = fit(vectors, queries, k, tables, bits, steps, sample, target)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    hashing, probes = fitted
    index = cut_lineage(_cells(vectors, hashing, tables))
    # The directory of cells: pieces of large ones, and the task of every piece.
    tasks = max(1, math.ceil(vectors.count() / cell))
    directory = index.groupBy("tab", "cell").agg(F.count(F.lit(1)).alias("n"))
    directory = directory.withColumn("pieces", F.ceil(F.col("n") / cell).cast("int")).drop("n")
    task = F.pmod(F.xxhash64("tab", "cell", "piece"), F.lit(tasks)).cast("int") + F.col("tab") * tasks
    piece = F.pmod(F.xxhash64("gid"), F.col("pieces")).cast("int")
    stored = index.join(directory, ["tab", "cell"]).withColumn("piece", piece).withColumn("task", task)
    visits = (
        _visits(queries, hashing, tables, probes)
        .join(directory, ["tab", "cell"])
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("task", task)
        .groupBy("gid", "task")
        .agg(F.collect_set("cell").alias("cells"))  # at most the probes of one table
    )
    visits = cut_lineage(visits.join(queries, "gid"))
    shares = visits.groupBy("task").agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("copies"))
    share = F.pmod(F.xxhash64("gid"), F.col("copies")).cast("int")
    left = stored.join(shares, "task").select(
        "task", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"),
        "gid", "v", F.array("cell").alias("cells"),
    )
    right = visits.join(shares, "task").select("task", share.alias("copy"), F.lit(1).alias("kind"), "gid", "v", "cells")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks * tables)
    met = (
        left.unionByName(right)
        .repartition(parts, "task", "copy")
        .sortWithinPartitions("task", "copy", "kind")
        .mapInArrow(_meet(k + 1), "q long, gid long, score double")
    )
    # A pair may meet in several tables; its score is the same in each.
    top = F.rank().over(W.partitionBy("q").orderBy(F.desc("score")))
    met = met.distinct().withColumn("n", top).where(F.col("n") <= k + 1)
    spread = met.join(vectors.select("gid", "ids"), "gid").select("q", "score", F.explode("ids").alias("vec_id"))
    best = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    lists = spread.withColumn("n", best).where(F.col("n") <= k + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found")
    )
    own = F.filter("found", lambda f: f["vec_id"] != F.col("query_id"))
    return (
        asked.join(lists, F.col("gid") == F.col("q"))
        .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("pos", "f"))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "f.vec_id", "f.score")
    )


@query()
def op9_nearest(spark, sf_dir):
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
