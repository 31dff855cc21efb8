"""Source divergence audit: exact frequency filter, sharded minimal perfect hashes, recount into dense slots.

Terms are runs of letters (A-Z lower-cased) and of characters beyond ASCII. A language keeps the terms that occur in at
least ``MIN_DOCS`` of its texts. Every source of a language is compared with the others and with the language.

1. First pass: tasks count the texts of each (language, term) and Spark adds up; the filter is exact.
2. The kept terms of a language fall into shards of about ``SHARD`` terms by hash. A task builds each shard's minimal perfect
   hash: level after level a term takes the bit it has alone, the others go on to the next level; a term's slot is
   the rank of its bit. The terms lie beside it in slot order, so a lookup is verified by the stored term itself.
3. Second pass: a round broadcasts at most ``ROUND`` terms' shards, whatever the vocabulary; a table of more terms takes
   more rounds, each of one scan. Tasks add to one dense array of slots per (language, source), which is given out and
   begun anew when all arrays of a task exceed ``DENSE`` slots. Spark adds up the slots.
4. ``p`` is a count smoothed by ``PRIOR`` in units of 1 / ``UNITS``, in whole numbers and exact decimals throughout. Pairs of sources are
   compared block by block of terms: a task holds the p of some terms for all sources of a language.

NULL text, language and source are empty strings; every (language, source) that occurs is a group, also without terms.
Very long texts are cut into words whole, one at a time. Ties in value go by the item's bytes; repeated rows are texts of
their own. An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.llm.common import read, slices, tidied
from ledgerlark.llm.registry import query
from ledgerlark.session import cut_lineage

MIN_DOCS = 30
PRIOR, UNITS = 5, 1_000_000_000
TOP = 50
#: Terms of a shard and of a round's broadcast, distinct terms and slots that a task holds; none changes the result.
SHARD, ROUND = 4096, 2_000_000
HELD, DENSE = 400_000, 8_000_000
#: Cells of the largest block of terms by sources.
BLOCK = 4_000_000

_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TERM).split()


# --- minimal perfect hashes ---------------------------------------------------------------------


def hashes(keys: list[bytes], seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(k, seed) for k in keys), np.uint64, len(keys))


def _place(h: np.ndarray, level: int, size) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (h ^ np.uint64(level + 1)) * _ODD
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x ^= x >> np.uint64(29)
    return (x % size).astype(np.int64)


def build(keys: list[bytes]) -> tuple[int, list[np.ndarray], np.ndarray]:
    """(seed, bits of each level, order): ``order`` has the keys' numbers by slot."""
    seed = 42
    while len(np.unique(hashes(keys, seed))) < len(keys):
        seed += 1
    h, left = hashes(keys, seed), np.arange(len(keys))
    levels, order = [], []
    while len(left):
        size = 2 * len(left) + 1
        at = _place(h[left], len(levels), np.uint64(size))
        alone = np.bincount(at, minlength=size)[at] == 1
        bits = np.zeros(size, bool)
        bits[at[alone]] = True
        levels.append(bits)
        order.append(left[alone][np.argsort(at[alone])])
        left = left[~alone]
    return seed, levels, np.concatenate(order)


@dataclass
class Perfect:
    """The shards of one language: bits of all levels in one array, ranks, and the stored terms by slot."""

    seeds: np.ndarray  # per shard
    start: np.ndarray  # (shard, level): first bit
    size: np.ndarray  # (shard, level): bits, 0 beyond the last level
    bits: np.ndarray
    rank: np.ndarray  # slots before each bit
    keys: pa.Array
    cells: np.ndarray  # slot to (shard, number within the shard)
    which: dict[int, int]  # shard to its row here
    shards: int  # of the language, here or in other rounds

    @classmethod
    def of(cls, rows: list[dict], shards: int) -> Perfect:
        depth = max(len(r["sizes"]) for r in rows)
        size = np.zeros((len(rows), depth), np.uint64)
        for i, r in enumerate(rows):
            size[i, : len(r["sizes"])] = r["sizes"]
        bits = np.concatenate([np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=sum(r["sizes"])) for r in rows]).astype(bool)
        flat = size.ravel().astype(np.int64)
        start = (np.cumsum(flat) - flat).reshape(size.shape)
        keys = [k for r in rows for k in r["keys"]]
        cells = np.concatenate([(np.int64(r["shard"]) << 32) + np.arange(len(r["keys"])) for r in rows])
        which = {r["shard"]: i for i, r in enumerate(rows)}
        seeds = np.array([r["seed"] for r in rows])
        return cls(seeds, start, size, bits, np.cumsum(bits) - bits, pa.array(keys, pa.binary()), cells, which, shards)

    def slots(self, words: list[bytes]) -> np.ndarray:
        """The slot of each word, -1 where it is not a stored term."""
        h = hashes(words, 42)
        part = (h.view(np.int64) % self.shards).astype(np.int64)
        row = np.full(self.shards, -1, np.int64)
        row[list(self.which)] = list(self.which.values())
        row = row[part]
        for seed in np.unique(self.seeds[self.seeds != 42]):
            again = np.flatnonzero((row >= 0) & (self.seeds[row] == seed))
            h[again] = hashes([words[i] for i in again], int(seed))
        slot = np.full(len(words), -1, np.int64)
        todo = np.flatnonzero(row >= 0)
        for level in range(self.size.shape[1]):
            todo = todo[self.size[row[todo], level] > 0]
            if not len(todo):
                break
            at = self.start[row[todo], level] + _place(h[todo], level, self.size[row[todo], level])
            hit = self.bits[at]
            slot[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
        found = np.flatnonzero(slot >= 0)
        stored = self.keys.take(pa.array(slot[found]))
        same = pc.equal(stored, pa.array([words[i] for i in found.tolist()], pa.binary())).to_numpy(zero_copy_only=False)
        slot[found[~same]] = -1
        return slot


# --- the two passes -----------------------------------------------------------------------------


def _columns(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    named = {"text": text_col, "lang": lang_col, "source": source_col}
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()])


def term_texts(texts: DataFrame) -> DataFrame:
    """(lang, term, n): in how many texts of the language a term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def give():
            for lang, count in held.items():
                arrays = [pa.array([lang] * len(count)), pa.array(list(count)).cast(pa.string()), pa.array(count.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "term", "n"])
            held.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(set(terms(text.as_py())))
            if sum(map(len, held.values())) > HELD:
                yield from give()
        yield from give()

    parts = texts.select("text", "lang").mapInArrow(tidied(run), "lang string, term string, n long")
    return parts.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def perfect_shards(kept: DataFrame, per_shard: int = SHARD) -> tuple[DataFrame, int]:
    """One row per shard of a language, and the number of shards a language may have."""
    shards = max(1, ceil(kept.count() / per_shard))

    def make(table: pa.Table) -> pa.Table:
        keys = [k.encode() for k in table.column("term").to_pylist()]
        seed, levels, order = build(keys)
        row = {
            "lang": table.column("lang")[0].as_py(), "shard": table.column("shard")[0].as_py(), "seed": seed, "n": len(keys),
            "sizes": [len(x) for x in levels], "bits": np.packbits(np.concatenate(levels)).tobytes(),
            "keys": [keys[i] for i in order.tolist()],
        }
        return pa.Table.from_pylist([row], schema=_SHARD)

    hashed = kept.select("lang", "term", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"))
    schema = "lang string, shard int, seed int, n int, sizes array<int>, bits binary, keys array<binary>"
    return hashed.groupBy("lang", "shard").applyInArrow(make, schema), shards


_SHARD = pa.schema(
    [("lang", pa.string()), ("shard", pa.int32()), ("seed", pa.int32()), ("n", pa.int32()), ("sizes", pa.list_(pa.int32())),
     ("bits", pa.binary()), ("keys", pa.list_(pa.binary()))]
)


def _rounds(shards: DataFrame, most: int) -> list[list[tuple[str, int]]]:
    """The shards in order, cut where a round would hold more than ``most`` terms."""
    out: list[list[tuple[str, int]]] = []
    total = 0
    for r in shards.select("lang", "shard", "n").orderBy("lang", "shard").collect():
        if not out or total + r["n"] > most:
            out.append([])
            total = 0
        out[-1].append((r["lang"], r["shard"]))
        total += r["n"]
    return out


def _recount(texts: DataFrame, shards: DataFrame, some: list[tuple[str, int]], parts: int) -> DataFrame:
    """(lang, source, cell, n) of the terms of some shards; a cell is (shard, number within the shard)."""
    (first, low), (last, high) = some[0], some[-1]
    from_first = (F.col("lang") > first) | ((F.col("lang") == first) & (F.col("shard") >= low))
    to_last = (F.col("lang") < last) | ((F.col("lang") == last) & (F.col("shard") <= high))
    by_lang: dict[str, list[dict]] = {}
    for r in shards.where(from_first & to_last).orderBy("lang", "shard").toArrow().to_pylist():
        by_lang.setdefault(r["lang"], []).append(r)
    shared = texts.sparkSession.sparkContext.broadcast({x: Perfect.of(rows, parts) for x, rows in by_lang.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, Perfect] = shared.value
        dense: dict[tuple[str, str], np.ndarray] = {}

        def give():
            for (lang, source), count in dense.items():
                at = np.flatnonzero(count)
                same = [pa.array([x] * len(at), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(tables[lang].cells[at]), pa.array(count[at])], names=["lang", "source", "cell", "n"]
                )
            dense.clear()

        for whole in batches:
            all_texts = whole.column(0).to_pylist()
            for lo, hi in slices(all_texts, rows=8192, chars=8_000_000):
                groups: dict[tuple[str, str], list[str]] = {}
                keys = zip(*(whole.column(k).slice(lo, hi - lo).to_pylist() for k in (1, 2)), strict=True)
                for key, text in zip(keys, all_texts[lo:hi], strict=True):
                    if key[0] in tables:
                        groups.setdefault(key, []).append(text)
                for key, many in groups.items():
                    count = Counter(terms(" ".join(many)))
                    table = tables[key[0]]
                    slot = table.slots(list(count))
                    number = np.fromiter(count.values(), np.int64, len(count))
                    known = slot >= 0
                    if key not in dense:
                        dense[key] = np.zeros(len(table.cells), np.int64)
                    dense[key][slot[known]] += number[known]
                    if sum(map(len, dense.values())) > DENSE:
                        yield from give()
        yield from give()

    counted = texts.mapInArrow(tidied(run), "lang string, source string, cell long, n long")
    return counted.groupBy("lang", "source", "cell").agg(F.sum("n").alias("n"))


def _terms_of(shards: DataFrame) -> DataFrame:
    """(lang, cell, term) of every kept term."""
    rows = shards.select("lang", "shard", F.posexplode("keys").alias("i", "key"))
    cell = F.col("shard").cast("long") * F.lit(1 << 32) + F.col("i")
    return rows.select("lang", cell.alias("cell"), F.col("key").cast("string").alias("term"))


# --- divergences --------------------------------------------------------------------------------


def _share(count: str, total: str, size: str) -> Column:
    """1 + floor(UNITS * (count + PRIOR) / (total + PRIOR * size)), exact; NULL without kept terms."""
    above = f"cast({UNITS} as decimal(10,0)) * cast({count} + {PRIOR} as decimal(19,0))"
    below = f"cast({total} + {PRIOR} * {size} as decimal(19,0))"
    return F.expr(f"case when {size} > 0 then 1 + ({above}) div ({below}) end")


def _pair_sums(cells: DataFrame, groups: DataFrame, blocks: int) -> DataFrame:
    """(lang, source, item, value): the summed difference of each two sources of a language."""
    rest = groups.select("lang", "source", F.lit(-1).cast("long").alias("cell"), F.coalesce("zero", F.lit(0)).alias("p"))
    rest = rest.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    known = cells.select("lang", "source", "cell", "p", F.pmod(F.xxhash64("cell"), F.lit(blocks)).cast("int").alias("block"))

    def compare(table: pa.Table) -> pa.Table:
        cell, p = (table.column(c).to_numpy() for c in ("cell", "p"))
        source = table.column("source").combine_chunks().dictionary_encode()
        names, code = source.dictionary, source.indices.to_numpy()
        one = cell < 0
        if len(names) < 2:
            return pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.string(), pa.int64())], names=out)
        number, at = np.unique(cell[~one], return_inverse=True)
        matrix = np.zeros((len(names), len(number)), np.int64)
        zero = np.zeros(len(names), np.int64)
        zero[code[one]] = p[one]
        matrix[:] = zero[:, None]
        matrix[code[~one], at] = p[~one]
        sums = np.stack([np.abs(matrix - matrix[i]).sum(axis=1) for i in range(len(names))])
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        lang = pa.array([table.column("lang")[0].as_py()] * len(a), pa.string())
        return pa.table([lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(sums[a, b])], names=out)

    out = ["lang", "source", "item", "value"]
    parts = known.unionByName(rest).groupBy("lang", "block").applyInArrow(compare, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, per_shard: int = SHARD, per_round: int = ROUND,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source the others of its language by their summed difference
    (part ``pair``), and the ``top`` terms it has more often than its language (part ``term``)."""
    texts = _columns(docs, text_col, lang_col, source_col)
    kept = cut_lineage(term_texts(texts).where(F.col("n") >= min_docs).select("lang", "term"))
    shards, parts = perfect_shards(kept, per_shard)
    shards = cut_lineage(shards)
    counts = None
    for some in _rounds(shards, per_round):
        part = _recount(texts, shards, some, parts)
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = texts.sparkSession.createDataFrame([], "lang string, source string, cell long, n long")
    counts = cut_lineage(counts)

    size = shards.groupBy("lang").agg(F.sum("n").alias("size"))
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(size, "lang", "left").join(total, ["lang", "source"], "left")
    groups = groups.fillna(0, ["size", "total"]).withColumn("none", F.lit(0).cast("long"))
    groups = cut_lineage(groups.withColumn("zero", _share("none", "total", "size")).drop("none"))
    cells = counts.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "size"))

    sources = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    terms_per_block = min(4096, max(64, BLOCK // sources))
    pair = _pair_sums(cells, groups, max(1, ceil((shards.agg(F.max("n")).first()[0] or 0) * parts / terms_per_block)))

    whole = counts.groupBy("lang", "cell").agg(F.sum("n").alias("all_n"))
    all_total = whole.groupBy("lang").agg(F.sum("all_n").alias("all_total"))
    whole = whole.join(all_total, "lang").join(size, "lang").select("lang", "cell", _share("all_n", "all_total", "size").alias("q"))
    above = cells.join(whole, ["lang", "cell"]).where("p > q").join(_terms_of(shards), ["lang", "cell"])
    term = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    ranked = [
        pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank),
        term.select("lang", "source", F.lit("term").alias("part"), "item", "value", rank).where(F.col("rank") <= top),
    ]
    return ranked[0].unionByName(ranked[1])


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
t AS (SELECT i, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= {MIN_DOCS}),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(c) AS total FROM n GROUP BY ALL),
cell AS (
  SELECT g.lang, g.source, k.term, coalesce(n.c, 0) AS c,
         1 + ({UNITS}::HUGEINT * (coalesce(n.c, 0) + {PRIOR})) // (coalesce(o.total, 0) + {PRIOR} * s.v)::HUGEINT AS p
  FROM grp g JOIN kept k USING (lang) JOIN size s USING (lang)
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
  LEFT JOIN total o ON o.lang = g.lang AND o.source = g.source),
whole AS (
  SELECT lang, term, 1 + ({UNITS}::HUGEINT * (sum(c) + {PRIOR})) // (any_value(tl) + {PRIOR} * any_value(v))::HUGEINT AS q
  FROM n JOIN (SELECT lang, sum(total) AS tl FROM total GROUP BY lang) USING (lang) JOIN size USING (lang) GROUP BY lang, term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN cell x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN cell y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
term AS (
  SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM cell JOIN whole USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, 'pair' AS part FROM pair UNION ALL BY NAME SELECT *, 'term' AS part FROM term)
SELECT * FROM (
  SELECT lang, source, part, item, value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM ranked)
WHERE part = 'pair' OR rank <= {TOP}
"""


@query(SQL)
def op13_divergence(spark, sf_dir):
    return audit(read(spark, sf_dir, "documents"))
