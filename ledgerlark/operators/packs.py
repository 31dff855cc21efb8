"""Comparing all vectors of two tables that may lie within reach of each other, pack by pack.

A pack is one row that holds up to a block of vectors with a middle and a radius; vectors near each other in the order of a metric tree
share one. Packs of two tables meet in the tasks of a cartesian product, which reads both tables where they are stored, so nothing is
shuffled before the comparison and tasks send out one result per vector they hold, not per vector and leaf. Pairs of packs whose balls lie
too far apart are left out. Inside a pair, squared distances come from a matrix product of single precision, whose error is bounded;
whatever it leaves open is computed entry by entry in double precision, so every answer is that of the plain formula.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions.scalars import squared_distance
from ledgerlark.session import cut_lineage

#: Rows of a matrix product, and pairs that are computed entry by entry at a time.
TILE, SOME = 256, 16_384
#: Share of a tile that single precision may leave open; beyond, the tile is made in double precision.
OPEN = 1 / 32


@dataclass
class Pack:
    """One side of a pair: its number, its vectors, middle and radius, and the other columns as arrays."""

    number: int
    x: np.ndarray
    middle: np.ndarray
    radius: float
    columns: dict[str, np.ndarray]

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]


def plain(values) -> np.ndarray:
    """An Arrow array as NumPy; with NULLs as objects, so that whole numbers stay whole."""
    return np.array(values.to_pylist() + [None], dtype=object)[:-1] if values.null_count else values.to_numpy(zero_copy_only=False)


def matrix(v) -> np.ndarray:
    """A column of vectors of one length as a matrix."""
    lengths = np.diff(v.offsets.to_numpy())
    if v.null_count or len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("all vectors must be there and have the same length")
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def packs(rows: DataFrame, columns: Sequence[str], size: int, group: int, reach_of: Callable | None = None) -> DataFrame:
    """``rows`` (cell, pid, v, reach, ...) as packs of at most ``size`` vectors, about ``group`` of them a partition at most.

    ``far`` is the largest ``reach`` of a pack, NULL if there is no such column; ``columns`` become arrays. ``reach_of`` may say
    the reach of a pack's rows, from the matrix of vectors and the columns.
    """
    types = dict(rows.dtypes)
    reach = F.col("reach") if "reach" in types else F.lit(None).cast("double").alias("reach")
    wanted = rows.select("cell", "v", reach, "pid", *[c for c in columns if c not in ("pid", "reach")])
    tasks = ceil(2 * sqrt(rows.sparkSession.sparkContext.defaultParallelism))
    n = ceil(rows.count() / size)
    parts = max(1, min(n, max(tasks, ceil(n / group))))
    schema = "middle array<double>, radius double, far double, v binary"
    schema += "".join(f", {c} array<{types[c]}>" for c in columns)

    def run(batches):
        import pyarrow as pa

        some = [b for b in batches if b.num_rows]
        if not some:
            return
        table = pa.Table.from_batches(some).sort_by("cell")
        count = ceil(table.num_rows / size)
        edges = [table.num_rows * i // count for i in range(count + 1)]
        for a, b in zip(edges, edges[1:]):
            part = table.slice(a, b - a).combine_chunks().to_batches()[0]
            x = matrix(part.column("v"))
            middle = x.mean(axis=0)
            radius = float(np.sqrt(((x - middle) ** 2).sum(axis=1)).max())
            far = part.column("reach").to_numpy(zero_copy_only=False)
            if reach_of is not None:
                far = reach_of(x, {c: plain(part.column(c)) for c in columns})
            entries = [[middle.tolist()], [radius], [None if np.isnan(far).any() else float(far.max())], [x.tobytes()]]
            types = [pa.list_(pa.float64()), pa.float64(), pa.float64(), pa.binary()]
            arrays = [pa.array(e, t) for e, t in zip(entries, types)]
            arrays += [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), part.column(c)) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["middle", "radius", "far", "v", *columns])

    dealt = wanted.repartitionByRange(parts, "cell", "pid")
    packed = dealt.mapInArrow(run, schema).coalesce(parts)
    return cut_lineage(packed.withColumn("pack", F.monotonically_increasing_id()))


def each_once() -> Column:
    """Of the pairs of a table with itself: every pack with itself, and of two packs one of both orders, as a hash says."""
    a, b = F.col("a_pack"), F.col("b_pack")
    return (a == b) | ((a < b) == (F.pmod(F.xxhash64(F.least(a, b), F.greatest(a, b)), F.lit(2)) == 0))


def meet(left: DataFrame, right: DataFrame, run: Callable, schema: str, where: Column | None = None) -> DataFrame:
    """``run`` over an iterator of pairs of packs, the left one being the same object while it stays; one task for two partitions.

    Pairs whose balls are farther apart than the left pack's ``far`` are left out, as are those not ``where``.
    """
    a, b = (t.select(*[F.col(c).alias(f"{side}_{c}") for c in t.columns]) for side, t in (("a", left), ("b", right)))
    gap = F.sqrt(squared_distance(F.col("a_middle"), F.col("b_middle")))
    apart = gap - F.col("a_radius") - F.col("b_radius")
    near = F.col("a_far").isNull() | F.isnan(gap) | (apart <= F.col("a_far") * (1 + 1e-9) + 1e-9 * (1 + gap))
    pairs = a.hint("shuffle_replicate_nl").join(b, near if where is None else near & where)

    def task(batches):
        yield from run(_pairs(batches))

    return pairs.mapInArrow(task, schema)


def _pairs(batches) -> Iterator[tuple[Pack, Pack]]:
    a = None
    for batch in batches:
        for i in range(batch.num_rows):
            number = batch.column("a_pack")[i].as_py()
            if a is None or a.number != number:
                a = _pack(batch, i, "a_", kept=True)
            yield a, _pack(batch, i, "b_")


def _pack(batch, i: int, side: str, kept: bool = False) -> Pack:
    """The pack of a row; one that is ``kept`` does not hold on to the batch."""
    middle = batch.column(side + "middle")[i].values.to_numpy(zero_copy_only=False)
    x = np.frombuffer(batch.column(side + "v")[i].as_buffer()).reshape(-1, len(middle))
    names = [c[2:] for c in batch.schema.names if c.startswith(side)]
    columns = {c: plain(batch.column(side + c)[i].values) for c in names if c not in ("pack", "middle", "radius", "far", "v")}
    if kept:
        x, middle, columns = x.copy(), middle.copy(), {c: v.copy() for c, v in columns.items()}
    return Pack(batch.column(side + "pack")[i].as_py(), x, middle, batch.column(side + "radius")[i].as_py(), columns)


def distances(x: np.ndarray, y: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Distances of chosen pairs, by the plain formula."""
    out = np.empty(len(rows))
    for a in range(0, len(rows), SOME):
        some = slice(a, a + SOME)
        out[some] = np.sqrt(((x[rows[some]] - y[cols[some]]) ** 2).sum(axis=1))
    return out


class Product:
    """Squared distances of all rows of ``x`` and ``y`` as a matrix product, and how far they may be off."""

    def __init__(self, x: np.ndarray, y: np.ndarray, single: bool = True):
        self.x, self.y, d = x, y, x.shape[1]
        middle = x.mean(axis=0)
        a, b = x - middle, y - middle
        aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        self.size = 2 * float(aa.max() + bb.max())
        kind = np.float32 if single and self.size < 1e30 else np.float64
        self.single = kind is np.float32
        self.left, self.right = np.empty((len(x), d + 2), kind), np.empty((len(y), d + 2), kind)
        self.left[:, :d], self.left[:, d], self.left[:, d + 1] = -2 * a, aa, 1
        self.right[:, :d], self.right[:, d], self.right[:, d + 1] = b, 1, bb
        self.unit = (d + 8) * float(np.finfo(kind).eps)
        self.kind = kind

    def slack(self, squared):
        """How far a product may be from a true squared distance that is compared with ``squared``."""
        return self.unit * (self.size + squared)

    def tile(self, a: int) -> np.ndarray:
        return self.left[a : a + TILE] @ self.right.T

    def double(self) -> Product:
        if not hasattr(self, "_double"):
            self._double = Product(self.x, self.y, single=False)
        return self._double


def within(x: np.ndarray, y: np.ndarray, limit: float) -> Iterator[tuple[int, np.ndarray]]:
    """Per tile of rows of ``x``: its first row, and whether the distance to each row of ``y`` is at most ``limit``."""
    product = Product(x, y)
    for a in range(0, len(x), TILE):
        yield a, _near(product, a, limit)


def _near(product: Product, a: int, limit: float) -> np.ndarray:
    squared, slack = limit * limit, product.slack(limit * limit)
    g = product.tile(a)
    near = g <= product.kind(squared - slack)
    unclear = ~(g > product.kind(squared + slack)) ^ near
    at = np.flatnonzero(unclear)
    if product.single and len(at) > OPEN * g.size:
        return _near(product.double(), a, limit)
    if len(at):
        rows, cols = np.divmod(at, g.shape[1])
        near[rows, cols] = distances(product.x, product.y, a + rows, cols) <= limit
    return near


def at_most(product: Product, a: int, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the tile and rows of ``y``: all pairs that lie within the row's limit and may be among its ``k`` nearest."""
    g = product.tile(a)
    squared = limits[a : a + TILE] ** 2
    loose = ~np.isfinite(squared)
    if loose.any() and k <= g.shape[1]:
        least = np.partition(g[loose], k - 1, axis=1)[:, k - 1].astype(float)
        least += product.slack(np.abs(least))
        squared[loose] = np.where(np.isfinite(least), least, np.inf)
    bound = (squared + product.slack(squared)).astype(product.kind)
    at = np.flatnonzero(~(g > bound[:, None]))
    if product.single and len(at) > max(OPEN * g.size, 2 * k * len(g)):
        return at_most(product.double(), a, limits, k)
    return np.divmod(at, g.shape[1])


def cheapest(product: Product, a: int, n: np.ndarray, m: np.ndarray, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the tile and rows of ``y``: all pairs of groups of sizes ``n`` and ``m`` that may be among the ``k`` merges
    that add least to the inner variance, and add at most the row's limit."""
    if product.single and product.size * max(n.max(), m.max()) > 1e30:
        product = product.double()
    g = product.tile(a)
    size, other = n[a : a + TILE, None].astype(product.kind), m[None, :].astype(product.kind)
    share = size * other / (size + other)
    # What a product may be off by; a few units more for the sizes.
    slack = product.kind(product.slack(0.0))
    least = (g - slack) * share * product.kind(1 - 1e-6)
    bound = limits[a : a + TILE].copy()
    loose = ~np.isfinite(bound)
    if loose.any() and k <= g.shape[1]:
        most = (g[loose] + slack) * share[loose] * product.kind(1 + 1e-6)
        some = np.partition(most, k - 1, axis=1)[:, k - 1].astype(float)
        bound[loose] = np.where(np.isfinite(some), some, np.inf)
    at = np.flatnonzero(~(least > (bound * (1 + 1e-6)).astype(product.kind)[:, None]))
    if product.single and len(at) > max(OPEN * g.size, 2 * k * len(g)):
        return cheapest(product.double(), a, n, m, limits, k)
    return np.divmod(at, g.shape[1])


def costs(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """What the merges of chosen pairs of groups with means ``x`` and ``y`` add to the inner variance, by the plain formula."""
    out = np.empty(len(rows))
    for a in range(0, len(rows), SOME):
        r, c = rows[a : a + SOME], cols[a : a + SOME]
        out[a : a + SOME] = ((x[r] - y[c]) ** 2).sum(axis=1) * (n[r] * m[c] / (n[r] + m[c]))
    return out


class Nearest:
    """The ``k`` nearest of the points seen so far, for each of ``n`` queries; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.d, self.found = np.full((n, k), np.inf), np.zeros((n, k), bool)
        self.ids: np.ndarray | None = None

    def limits(self) -> np.ndarray:
        """The distance of the k-th, without end if there are fewer."""
        return np.where(self.found[:, -1], self.d[:, -1], np.inf)

    def add(self, rows: np.ndarray, d: np.ndarray, ids: np.ndarray) -> None:
        import pandas as pd

        if not len(rows):
            return
        if self.ids is None:
            self.ids = np.full(self.d.shape, ids[0])
        if self.ids.dtype != ids.dtype:  # text of other lengths, or NULLs
            self.ids, ids = self.ids.astype(object), ids.astype(object)
        some, at = np.unique(rows, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(some)), self.k), at])
        d = np.concatenate([self.d[some].ravel(), d])
        found = np.concatenate([self.found[some].ravel(), np.ones(len(at), bool)])
        ids = np.concatenate([self.ids[some].ravel(), ids])
        rank = pd.factorize(ids, sort=True)[0] if ids.dtype == object else ids
        order = np.lexsort((rank, d, ~found, row))
        first = np.searchsorted(row[order], np.arange(len(some)))
        take = order[first[:, None] + np.arange(self.k)]
        self.d[some], self.found[some], self.ids[some] = d[take], found[take], ids[take]
