"""SimHash near-duplicates: pigeonring candidates, exact Hamming check, connected components.

1. Fingerprints: word shingles hashed with XXH64, one vote per shingle and bit.
2. Equal fingerprints are one node, so copies cost one row from here on.
3. Pigeonring: the 64 bits form a ring of ``SEGMENTS`` segments. If two fingerprints differ in at
   most r bits, some chain of consecutive segments, begun at a suitable one, has at every length l a
   total difference of at most l * r / SEGMENTS. Up to the length ``run`` that budget is below one
   bit, so the first ``run`` segments of the chain are equal: they are the key under which fingerprints
   meet, one key per start. Every pair that meets has its whole chain checked before the full
   Hamming distance.
4. A bucket with more than ``BUCKET`` fingerprints is split without losing a pair: of r + 1 parts of the
   bits that its key does not cover, one must be equal, so the bucket becomes r + 1 sets of smaller buckets, again and
   again. The keys grow until a bucket cannot hold more than 2 ** (uncovered bits) fingerprints.
5. Within a bucket only links that join two groups are given out, at most one less than its members.
6. Components are found by repeated star contraction over the links.

NULL and empty texts have fingerprint zero and are linked like any other. Repeated rows are nodes
of their own with the same result. Rows with a NULL id take part; a component without any id has a
NULL component_id. An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ledgerlark.llm.common import id_and_text, per_text, read, tidied, with_column
from ledgerlark.llm.registry import query
from ledgerlark.session import cut_lineage

SHINGLE = 3
RADIUS = 2
SEGMENTS = 16
#: A bucket with more fingerprints is split; every bucket size gives the same links.
BUCKET = 256

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash as a signed 64-bit integer; words are parted by blank, tab, line feed to return."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), 42)).astype(np.int64))
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(size + 1) - size - 1
    ends = (starts + size)[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends)], "<u8")
    votes = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[lo : lo + 65_536].view(np.uint8), bitorder="little")
        votes += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per row."""

    def make():
        return lambda text: (fingerprint(text, shingle),)

    return per_text(id_and_text(docs, id_col, text_col), make, "fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _parts(bits: list[int], n: int) -> list[list[int]]:
    """Bits in n runs of nearly equal length."""
    edge = [round(i * len(bits) / n) for i in range(n + 1)]
    return [bits[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]


class Ring:
    """Segments, budgets and the masks of all keys down to the finest."""

    def __init__(self, radius: int = RADIUS, segments: int = SEGMENTS, finest: int = 11):
        self.radius, self.segments = radius, segments
        seg = _parts(list(range(64)), segments)
        self.edges = np.array([s[0] for s in seg] + [64])
        self.budget = [l * radius // segments for l in range(1, segments + 1)]
        run = max(1, sum(b == 0 for b in self.budget))
        level = []
        for s in range(segments):
            covered = {b for k in range(run) for b in seg[(s + k) % segments]}
            level.append((s, covered))
        self.levels: list[list[tuple[int, int]]] = []  # per level (mask, start); children follow in order
        while True:
            self.levels.append([(_signed(sum(1 << b for b in c)), s) for s, c in level])
            if 64 - min(len(c) for _, c in level) <= finest:
                break
            level = [
                (s, c | set(part))
                for s, c in level
                for part in _parts([b for b in range(64) if b not in c], radius + 1)
            ]

    def links(self, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether each pair keeps the budget of every chain length from its start, the full distance last."""
        x = (a ^ b).view(np.uint64)
        total = np.zeros(len(x), np.int64)
        alive = np.ones(len(x), bool)
        for k, most in enumerate(self.budget):
            s = (start + k) % self.segments
            width = (self.edges[s + 1] - self.edges[s]).astype(np.uint64)
            part = (x >> self.edges[s].astype(np.uint64)) & ((np.uint64(1) << width) - np.uint64(1))
            total += np.bitwise_count(part)
            alive &= total <= most
        return alive


def _joining(bucket: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Positions of links that join two groups of the same batch (a forest over the n places)."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    keep = []
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
            keep.append(k)
    return np.array(keep, np.int64)


def _bucket_links(ring: Ring):
    """Over rows sorted by (path, part), links within each bucket."""

    def solve(key: np.ndarray, start: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``key`` numbers the buckets; rows of one bucket are neighbours."""
        size = np.diff(np.append(np.flatnonzero(np.diff(key, prepend=key[0] - 1)), len(key)))
        rest = np.concatenate([np.arange(s - 1, -1, -1) for s in size])  # rows after this one in its bucket
        left, right = [], []
        rows, step = np.flatnonzero(rest > 0), 1
        while len(rows):
            ok = ring.links(fp[rows], fp[rows + step], start[rows])
            left.append(rows[ok])
            right.append(rows[ok] + step)
            step += 1
            rows = rows[rest[rows] >= step]
        a, b = np.concatenate(left or [rows]), np.concatenate(right or [rows])
        keep = _joining(key, a, b, len(key))
        return fp[a[keep]], fp[b[keep]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3  # path, part and fp of the last, unfinished bucket
        starts = None

        def done(path, part, fp):
            change = (np.diff(path) != 0) | (np.diff(part) != 0)
            key = np.concatenate([[0], np.cumsum(change)])
            a, b = solve(key, path // _PATHS, fp)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            path, part, fp = (np.concatenate([h, x]) for h, x in zip(held, new, strict=True))
            if not len(path):
                continue
            last = np.flatnonzero((path != path[-1]) | (part != part[-1]))
            cut = last[-1] + 1 if len(last) else 0
            held = [path[cut:], part[cut:], fp[cut:]]
            if cut:
                yield done(path[:cut], part[:cut], fp[:cut])
        if len(held[0]):
            yield done(*held)

    return run


#: path = start * _PATHS + number of the mask among those of its start.
_PATHS = 1 << 20


def links(nodes: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) with a < b: links that connect exactly what all pairs within ``radius`` bits connect.

    ``nodes`` has one row per distinct ``fp``.
    """
    ring = Ring(radius, segments)
    keyed, out = None, None
    for depth, masks in enumerate(ring.levels):
        per_start = len(masks) // segments
        if depth == 0:
            choices = [(s * _PATHS, m) for m, s in masks]
            keyed = nodes.select("fp", F.explode(F.array(*[_key(p, m) for p, m in choices])).alias("k"))
        else:
            # The masks of this level that refine the one a row has.
            table = F.array(*[F.lit(m) for m, _ in masks])
            number = F.col("path") % _PATHS
            first = F.floor(F.col("path") / _PATHS) * per_start + number * (radius + 1)
            keyed = keyed.select(
                "fp",
                F.explode(
                    F.transform(
                        F.sequence(F.lit(0), F.lit(radius)),
                        lambda i: F.struct(
                            (F.floor(F.col("path") / _PATHS) * _PATHS + number * (radius + 1) + i).cast("long").alias("path"),
                            F.col("fp").bitwiseAND(F.get(table, (first + i).cast("int"))).alias("part"),
                        ),
                    )
                ).alias("k"),
            )
        keyed = keyed.select("fp", "k.path", "k.part")
        sized = cut_lineage(keyed.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("path", "part"))).where("n > 1"))
        final = depth == len(ring.levels) - 1
        small = sized if final else sized.where(F.col("n") <= bucket)
        found = (
            small.select("path", "part", "fp")
            .sortWithinPartitions("path", "part")
            .mapInArrow(tidied(_bucket_links(ring)), "a long, b long")
        )
        out = found if out is None else out.unionByName(found)
        if not final:
            keyed = sized.where(F.col("n") > bucket).drop("n")
            if keyed.isEmpty():
                break
    return out.distinct()


def _key(path: int, mask: int):
    return F.struct(F.lit(path).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(mask).cast("long")).alias("part"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): root is the smallest node it is connected to.

    Alternates large-star and small-star: each round links every node to the smallest it
    sees, and rounds end when nothing changes; their number grows with the logarithm of the edges.
    """
    edges = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(down, "a")
        small = star.select("a", F.col("m").alias("b")).union(star.select(F.col("b").alias("a"), F.col("m").alias("b")))
        new = cut_lineage(small.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if edges.exceptAll(new).isEmpty() and new.exceptAll(edges).isEmpty():
            break
        edges = new
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def _members(prints: DataFrame, radius: int, segments: int, bucket: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of (doc_id, fp)."""
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(prints.sparkSession, links(nodes.select("fp"), radius, segments, bucket))
    member = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return member.join(least, "root").select("fp", "root", "component_id")


def grouped(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS, bucket: int = BUCKET,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: fingerprint (16 hex digits) and component_id, the smallest id it is connected to."""
    prints = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    table = _members(prints, radius, segments, bucket).drop("root")
    return prints.join(table, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS, bucket: int = BUCKET,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest id, of several such the
    one with the smallest fingerprint, and of equal ones any."""

    prints = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    table = _members(prints, radius, segments, bucket)
    return first_rows(docs, prints, table, lambda text: fingerprint(text, shingle), id_col, text_col)


def first_rows(
    docs: DataFrame, prints: DataFrame, table: DataFrame, number: Callable[[str], int], id_col: str, text_col: str
) -> DataFrame:
    """The rows that ``keep_one`` keeps, from (doc_id, fp), (fp, root, component_id) and the fp of a text."""
    first = prints.join(table, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("root").agg(F.min("component_id").alias("least_id"), F.min("fp").alias("least_fp"))
    # Numbered column names, so that none of the table's can clash with those added here.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    c_id, c_text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    rows = plain.withColumns({"text": c_text.cast("string"), "mark": F.xxhash64(*plain.columns), "id": c_id.cast("long")})
    rows = with_column(rows, "text", "fp", "long", lambda: lambda texts: [number(t) for t in texts])
    again = F.row_number().over(W.partitionBy("id", "fp").orderBy("mark"))
    rows = rows.drop("text").withColumn("n", again).where("n = 1")
    same = F.col("id").eqNullSafe(F.col("least_id")) & (F.col("fp") == F.col("least_fp"))
    return rows.join(first, same, "left_semi").select(*plain.columns).toDF(*docs.columns)


@query()
def op6_simhash(spark, sf_dir):
    return grouped(read(spark, sf_dir, "documents"))
