"""Language-model scores from a hierarchical Pitman-Yor process.

A text is read word by word, each in the context of the word before it (at the start, of the end token). Every context u has a
restaurant that serves words: a word with c customers at t tables there has the predictive probability

    (c - d t + (theta + d T) P(word)) / (theta + C)

where C counts the restaurant's customers and T its tables. Every table is a customer of the restaurant without context, whose
predictive probability P has the same form; its tables are draws from P0, a spelling model that is itself a hierarchy of
restaurants: one per context of two bytes, whose parents are the contexts of one byte, whose common parent is the restaurant
without context, whose base is uniform over bytes and the end of the word. So unseen words and unseen pairs have a probability, and
what one context learns is shared through the parents.

Seating is sampled by Gibbs: in each round every (restaurant, dish) gets its customers seated anew given
all other seating (``seat``). A pair of words with one customer has one table, whatever the round: such pairs are constants, and only
pairs with two customers or more (``seated``) are kept and seated. Pairs and words are seated in parallel on Spark, and in each
round tell each other their tables, probabilities and contexts by shuffles; the byte restaurants have at most 257 ** 3 cells whatever
the corpus, and are seated on the driver. After ``BURN_IN`` rounds, the means over the rounds of the tables t and T of the contexts
and of the predictive probability P enter the formula above; so the words of every context still add up to one.

Texts meet the model in blocks: a block has numbers for its distinct words and asks, in one packed list per bucket of words
and of pairs, for their counts; the answers come back in the order of the lists. Only the texts and words of the blocks are kept
in files; their pairs go straight to their buckets, which form a grid (``cell``): a word meets one row of it as context and one
column as the word after. The seating of a bucket is one packed row, and buckets of words and of pairs tell each other one packed
list per round. Words are told apart by their XXH64; two words of the corpus with the same one fail the query.

Texts whose crc32(id as text) mod 5 is 1 are held out; a NULL id is never held out. NULL and empty texts are one
end token. Repeated rows count as often as they stand there and get the same scores. An empty table gives an empty
one; without training texts the model is the uniform spelling model. Other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from copy import copy
from functools import cache
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.llm.common import id_and_text, read, tidied
from ledgerlark.llm.registry import query
from ledgerlark.session import scratch_path

FOLDS, HELD = 5, 1
ROUNDS, BURN_IN = 5, 2
#: Up to so many customers of a dish, its number of tables is drawn from the exact conditional distribution.
EXACT = 128
PAIR_DISCOUNT, PAIR_STRENGTH = 0.75, 5.0
WORD_DISCOUNT, WORD_STRENGTH = 0.6, 100.0
BYTE_DISCOUNT, BYTE_STRENGTH = 0.5, 5.0
#: Tokens after which a task begins a new block.
BLOCK_TOKENS = 3_000_000
SEED = 5

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
END, START, SYMBOLS = 256, 256, 257


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


# --- texts to blocks -------------------------------------------------------------------------------


_BLOCK = "block long, ids array<long>, sizes binary, data binary, width binary, text binary, home binary"
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


def blocks(docs: DataFrame, buckets: int, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block: its texts' ids and packed lengths and word numbers, and its words' packed lengths, bytes and buckets.

    Words are numbered by how often they stand in the block. The end token is the empty word, the last of every text."""

    def row(block: int, ids: list, seqs: list[np.ndarray], number: dict[bytes, int]) -> pa.RecordBatch:
        seq, sizes = np.concatenate(seqs), np.array([len(x) for x in seqs], np.uint32)
        order = np.argsort(-np.bincount(seq, minlength=len(number)), kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        names = list(number)
        names = [names[i] for i in order.tolist()]
        width, home = np.array([len(w) for w in names], np.uint32), (hashes(names) % np.uint64(buckets)).astype(np.uint32)
        packed = [_pack(x) for x in (sizes, place[seq], width, np.frombuffer(b"".join(names), np.uint8), home)]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in packed)], names=_BLOCK_NAMES
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        number: dict[bytes, int] = {b"": 0}
        ids, seqs, size = [], [], 0
        for whole in batches:
            for i, text in zip(whole.column(0).to_pylist(), whole.column(1).to_pylist(), strict=True):
                some = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
                seq = np.zeros(len(some) + 1, np.int32)
                seq[:-1] = [number.setdefault(w, len(number)) for w in some]
                ids.append(i)
                seqs.append(seq)
                size += len(seq)
                if size >= tokens:
                    yield row((task << 24) + serial, ids, seqs, number)
                    serial, number, ids, seqs, size = serial + 1, {b"": 0}, [], [], 0
        if size:
            yield row((task << 24) + serial, ids, seqs, number)

    return docs.mapInArrow(tidied(run), _BLOCK)


class Block:
    """One row of ``blocks``."""

    def __init__(self, row: dict):
        self.number, self.ids = row["block"], row["ids"]
        self.sizes = _unpack(row["sizes"], np.uint32)[0].astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.words = _unpack(row["data"], np.uint32)[0].astype(np.int64)
        self.home = _unpack(row["home"], np.uint32)[0].astype(np.int64)
        self.width, self.text = row.get("width"), row.get("text")
        self.held = [held_out(i) for i in self.ids]

    def learnt(self) -> np.ndarray:
        return np.repeat(~np.array(self.held), self.sizes)

    def names(self) -> list[bytes]:
        return _cut(_unpack(self.width, np.uint32)[0], _unpack(self.text, np.uint8)[0])

    def code(self) -> np.ndarray:
        """Per token the word before it and itself, as one number; before a text's first word stands the end token of the last text."""
        return np.roll(self.words, 1) * len(self.home) + self.words

    def stretches(self, tokens: int = 250_000) -> Iterator[slice]:
        """Its texts in stretches of some ``tokens``, for arrays that need not be as long as the block."""
        ends = np.searchsorted(self.ends, np.arange(tokens, self.ends[-1], tokens)) + 1
        cuts = np.unique(np.concatenate([[0], ends, [len(self.ends)]])).tolist()
        return (slice(lo, hi) for lo, hi in zip(cuts, cuts[1:]))


_ASKED = "bucket int, block long, data binary, text binary"


def _lists(made: DataFrame, lists: Callable[[Block], Iterator[tuple[int, bytes, bytes]]]) -> DataFrame:
    """The lists that blocks send to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = Block(batch.slice(k, 1).to_pylist()[0])
                made = list(lists(block))
                for lo in range(0, len(made), 64):
                    bucket, data, text = zip(*made[lo : lo + 64], strict=True)
                    n = len(bucket)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket, pa.int32()), pa.array(np.full(n, block.number)), pa.array(data, pa.binary()), pa.array(text, pa.binary())],
                        names=["bucket", "block", "data", "text"],
                    )

    return made.mapInArrow(tidied(run), _ASKED)


def word_lists(block: Block) -> Iterator[tuple[int, bytes, bytes]]:
    """Per bucket the block's words, by number: lengths and counts in training texts, and bytes."""
    names = block.names()
    count = np.bincount(block.words[block.learnt()], minlength=len(names)).astype(np.uint32)
    order = np.argsort(block.home, kind="stable")
    for some in _runs(order, block.home[order]):
        mine = [names[i] for i in some.tolist()]
        size = np.array([len(w) for w in mine], np.uint32)
        yield int(block.home[some[0]]), _pack(size, count[some]), _pack(np.frombuffer(b"".join(mine), np.uint8))


def pair_lists(buckets: int) -> Callable[[Block], Iterator[tuple[int, bytes, bytes]]]:
    """Per bucket the block's pairs, in the order of ``pair_order``: places of context and word among the words that stand there,
    counts in training texts; and the hashes of those words."""

    def lists(block: Block) -> Iterator[tuple[int, bytes, bytes]]:
        pair, count = _distinct(block.code(), block.learnt())
        into, order = pair_order(pair, block.home, buckets)
        h, size = hashes(block.names()), len(block.home)
        for some in _runs(order, into[order]):
            u, w = pair[some] // size, pair[some] % size
            known, at = np.unique(np.concatenate([u, w]), return_inverse=True)
            at = at.astype(np.uint32)
            step = np.diff(at[: len(u)], prepend=np.uint32(0))
            yield int(into[some[0]]), _pack(step, at[len(u) :], count[some].astype(np.uint32)), _pack(h[known])

    return lists


def _runs(values: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
    """Values cut where their ascending key changes."""
    return np.split(values, np.flatnonzero(np.diff(key)) + 1) if len(values) else []


def _cut(width: np.ndarray, text: np.ndarray) -> list[bytes]:
    at = np.append(0, np.cumsum(width.astype(np.int64))).tolist()
    whole = text.tobytes()
    return [whole[a:b] for a, b in zip(at, at[1:])]


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))


def _distinct(pairs: np.ndarray, learnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, ascending, and how often they are learnt."""
    both = np.sort(pairs * 2 + learnt)
    first = np.flatnonzero(np.append(True, both[1:] >> 1 != both[:-1] >> 1))
    return both[first] >> 1, np.add.reduceat(both & 1, first)


def cell(context: np.ndarray, word: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of pairs, from those of their words: a grid, in which a word stands in one row and one column."""
    rows = isqrt(buckets)
    columns = buckets // rows
    return (context % rows) * columns + word % columns


def pair_order(pair: np.ndarray, home: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a block's ascending pairs, from those of its words, and the pairs' order by bucket."""
    into = cell(home[pair // len(home)], home[pair % len(home)], buckets)
    return into, np.argsort(into, kind="stable")


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, the bytes of one weight together, compressed."""
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in map(np.ascontiguousarray, arrays))
    return len(arrays[0]).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes, *types) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:4], "little"), 0, []
    if not n:
        return [np.zeros(0, t) for t in types]
    widths = [np.dtype(t).itemsize for t in types]
    planes = np.frombuffer(pa.decompress(data[4:], decompressed_size=n * sum(widths), codec="zstd", asbytes=True), np.uint8)
    for t, width in zip(types, widths, strict=True):
        out.append(np.ascontiguousarray(planes[at : at + n * width].reshape(width, n).T).view(t).ravel())
        at += n * width
    return out


# --- buckets: counts over all blocks ---------------------------------------------------------------

_BUCKET = "bucket int, block long, data binary, word binary, pos long, h long, c long"


def _bucket_rows(**columns) -> pa.Table:
    kinds = {"bucket": pa.int32(), "block": pa.int64(), "data": pa.binary(), "word": pa.binary(), "pos": pa.int64(), "h": pa.int64(), "c": pa.int64()}
    n = len(columns["bucket"])
    return pa.table({k: pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds.items()})


def count_words(asked: pa.Table) -> pa.Table:
    """Of one bucket: its words with their places and counts, and per block the places of the words it asked for."""
    counts, lists = [], []
    for data, text in zip(asked.column("data").to_pylist(), asked.column("text").to_pylist(), strict=True):
        size, count = _unpack(data, np.uint32, np.uint32)
        at = np.append(0, np.cumsum(size)).astype(np.int64)
        lists.append(pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(_unpack(text, np.uint8)[0])]))
        counts.append(count)
    coded = pa.concat_arrays(lists).dictionary_encode()
    place, n = coded.indices.to_numpy().astype(np.uint32), len(coded.dictionary)
    c = np.bincount(place, weights=np.concatenate(counts), minlength=n).astype(np.int64)
    bucket, ends = asked.column("bucket")[0].as_py(), np.cumsum([len(x) for x in counts])
    h = hashes(coded.dictionary.to_pylist())
    if len(np.unique(h)) < n:
        raise ValueError("two words have the same hash")
    words = _bucket_rows(bucket=np.full(n, bucket), word=coded.dictionary.cast(pa.binary()), pos=np.arange(n), h=h.view(np.int64), c=c)
    routes = _bucket_rows(
        bucket=np.full(len(ends), bucket), block=asked.column("block").combine_chunks(),
        data=[_pack(x) for x in np.split(place, ends[:-1])],
    )
    return pa.concat_tables([words, routes])


def count_pairs(asked: pa.Table) -> pa.Table:
    """Of one bucket: the pairs with two customers or more, and per block which of them it asked for.

    The pairs are one row: ``word`` holds the hashes of their words, ascending, and ``data`` per pair the places there
    of context and word, customers, tables and the sum of the kept rounds' tables. Blocks get 0 for a pair that
    training has not seen, 1 for one seen once, and from 2 on the places of the others.
    """
    names = [_unpack(d, np.uint64)[0] for d in asked.column("text").to_pylist()]
    lists = [_unpack(d, np.uint32, np.uint32, np.uint32) for d in asked.column("data").to_pylist()]
    known, at = np.unique(np.concatenate(names), return_inverse=True)
    at = np.split(at, np.cumsum([len(x) for x in names])[:-1])
    key = np.concatenate([x[np.cumsum(step, dtype=np.int64)] * len(known) + x[w] for x, (step, w, _) in zip(at, lists, strict=True)])
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.append(True, key[1:] != key[:-1])
    start = np.flatnonzero(first)
    c = np.add.reduceat(np.concatenate([x[2] for x in lists])[order].astype(np.int64), start)
    seated = c > 1
    answer = np.where(seated, np.cumsum(seated) + 1, c).astype(np.uint32)
    place = np.empty(len(order), np.uint32)
    place[order] = answer[np.cumsum(first) - 1]
    key, c = key[start[seated]], c[seated]
    used, at = np.unique(np.concatenate([key // len(known), key % len(known)]), return_inverse=True)
    known, at = known[used], np.split(at.astype(np.uint32), 2)
    bucket, ends = asked.column("bucket")[0].as_py(), np.cumsum([len(x[0]) for x in lists])
    state = _bucket_rows(bucket=[bucket], word=[_pack(known)], data=[_pair_state(*at, c, np.ones(len(c)), np.zeros(len(c)))])
    routes = _bucket_rows(
        bucket=np.full(len(ends), bucket), block=asked.column("block").combine_chunks(),
        data=[_pack(x) for x in np.split(place, ends[:-1])],
    )
    return pa.concat_tables([state, routes])


_PAIR = (np.uint32, np.uint32, np.int64, np.int64, np.int64)


def _pair_state(*columns: np.ndarray) -> bytes:
    return _pack(*(np.asarray(x).astype(t) for x, t in zip(columns, _PAIR, strict=True)))


# --- seating ---------------------------------------------------------------------------------------


@cache
def _log_stirling(discount: float, most: int) -> np.ndarray:
    """log of the generalised Stirling numbers: ways to seat c customers at t tables, at [c, t]."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        out[c + 1, 1 : c + 1] = np.log(c - t * discount) + out[c, 1 : c + 1]
        out[c + 1, 1 : c + 2] = np.logaddexp(out[c + 1, 1 : c + 2], out[c, : c + 1])
    return out


def seat(customers, base, others, strength: float, discount: float, rng: np.random.Generator):
    """Tables of each dish, drawn anew given the rest of the seating.

    ``base`` is the dish's probability in the parent, ``others`` the number of tables of all other dishes
    of its restaurant. Up to ``EXACT`` customers the number of tables is drawn from its conditional
    distribution, with the Stirling numbers for the ways to share the tables. More customers are seated in
    order by the Chinese-restaurant rule, from ``EXACT`` on in stretches of a twentieth, in which new tables are a
    Poisson number.
    """
    customers = np.asarray(customers, np.int64)
    base, others = np.asarray(base, np.float64), np.asarray(others, np.float64)
    tables = np.minimum(customers, 1)
    stirling = _log_stirling(discount, EXACT)
    few = np.flatnonzero((customers > 1) & (customers <= EXACT))
    few = few[np.argsort(customers[few], kind="stable")]
    edge = np.flatnonzero(np.diff(customers[few])) + 1
    for group in np.split(few, edge) if len(few) else ():
        c = int(customers[group[0]])
        t = np.arange(1, c + 1)
        for lo in range(0, len(group), max(1, 1_000_000 // c)):
            some = group[lo : lo + max(1, 1_000_000 // c)]
            free = strength + discount * others[some]
            weight = np.cumsum(np.log((free[:, None] + discount * (t - 1)) * base[some, None]), axis=1) + stirling[c, 1 : c + 1]
            tables[some] = 1 + (weight - np.log(-np.log(rng.random(weight.shape)))).argmax(axis=1)
    many = np.flatnonzero(customers > EXACT)
    t, n = np.ones(len(many)), 1.0
    live = np.arange(len(many))
    while len(live):
        c = customers[many[live]]
        new = (strength + discount * (others[many[live]] + t[live])) * base[many[live]]
        old = n - discount * t[live]
        if n < EXACT:
            t[live] += rng.random(len(live)) < new / (new + old)
            n += 1
        else:
            until = np.minimum(n + max(1.0, n // 20), c)
            t[live] += np.minimum(rng.poisson(new * np.log((until + new - n + old) / (new + old))), until - n)
            n += max(1.0, n // 20)
            live = live[c > n]
    tables[many] = t.astype(np.int64)
    return tables


class Spelling:
    """Byte restaurants with contexts of two, one and no bytes, and their predictive probabilities."""

    def __init__(self, strength: float = BYTE_STRENGTH, discount: float = BYTE_DISCOUNT):
        self.strength, self.discount = strength, discount
        self.state: list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None
        self.p0 = np.full(SYMBOLS, 1 / SYMBOLS)
        self.p1 = np.tile(self.p0, (SYMBOLS, 1))
        self.row = np.zeros(SYMBOLS * SYMBOLS, np.int32)
        self.p2 = self.p0[None, :].copy()

    def _level(self, context, symbol, count, parent, tables, rng):
        """One Gibbs round over the cells of a level, in two halves so that each sees the other's new tables."""
        for half in (0, 1):
            mine = np.flatnonzero((symbol + context) % 2 == half)
            total = np.bincount(context, weights=tables, minlength=int(context.max()) + 1 if len(context) else 1)
            tables[mine] = seat(
                count[mine], parent[mine], total[context[mine]] - tables[mine], self.strength, self.discount, rng
            )
        return tables

    def gibbs(self, context: np.ndarray, symbol: np.ndarray, count: np.ndarray, rng, rounds: int = 1) -> None:
        """Seat the customers of the two-byte contexts (numbered 257 * first + second) and of their parents."""
        if not len(context):
            return
        two = context * SYMBOLS + symbol
        order = np.argsort(two)
        two, count = two[order], count[order]
        c2, s2 = two // SYMBOLS, two % SYMBOLS
        if self.state is not None:  # tables of the round before, as far as the cells are the same
            old, t_old = self.state[0], self.state[1]
            at = np.searchsorted(old, two).clip(0, len(old) - 1)
            t2 = np.where(old[at] == two, np.minimum(t_old[at], count), 1)
        else:
            t2 = np.ones(len(two), np.int64)
        t2 = np.maximum(t2, 1)
        for _ in range(rounds):
            t2 = self._level(c2, s2, count, self.p1[c2 % SYMBOLS, s2], t2, rng)
            one, m1 = self._sum((c2 % SYMBOLS) * SYMBOLS + s2, t2)
            c1, s1 = one // SYMBOLS, one % SYMBOLS
            t1 = self._level(c1, s1, m1, self.p0[s1], np.ones(len(one), np.int64), rng)
            s0, m0 = self._sum(s1, t1)
            t0 = self._level(np.zeros(len(s0), np.int64), s0, m0, np.full(len(s0), 1 / SYMBOLS), np.ones(len(s0), np.int64), rng)
            self.p0 = self._predict(np.zeros(len(s0), np.int64), s0, m0, t0, np.full((1, SYMBOLS), 1 / SYMBOLS))[0]
            self.p1 = self._predict(c1, s1, m1, t1, np.tile(self.p0, (SYMBOLS, 1)))
        used = np.unique(c2)
        self.row = np.full(SYMBOLS * SYMBOLS, -1, np.int32)
        self.row[used] = np.arange(len(used))
        self.p2 = self._predict(self.row[c2].astype(np.int64), s2, count, t2, self.p1[used % SYMBOLS])
        self.state = (two, t2)

    @staticmethod
    def _sum(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u, inverse = np.unique(key, return_inverse=True)
        return u, np.bincount(inverse, weights=value).astype(np.int64)

    def _predict(self, context, symbol, count, tables, parent) -> np.ndarray:
        n = np.bincount(context, weights=count, minlength=len(parent))[:, None]
        t = np.bincount(context, weights=tables, minlength=len(parent))[:, None]
        out = (self.strength + self.discount * t) / (self.strength + n) * parent
        out[context, symbol] += (count - self.discount * tables) / (self.strength + n[context, 0])
        return out

    def log_base(self, words: list[bytes]) -> np.ndarray:
        """log P0 of words."""
        if not words:
            return np.zeros(0)
        context, symbol, owner = transitions(words)
        row = self.row[context]
        known = row >= 0
        p = self.p1[context % SYMBOLS, symbol]
        p[known] = self.p2[row[known], symbol[known]]
        return np.bincount(owner, weights=np.log(p), minlength=len(words))


def transitions(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context of two, symbol, number of the word) of every byte and of the ends."""
    size = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(size + 1) - 1  # place of the end of each word
    symbol = np.full(int(ends[-1]) + 1, END, np.int64)
    inside = np.ones(len(symbol), bool)
    inside[ends] = False
    symbol[inside] = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(words)), size + 1)
    at = np.arange(len(symbol)) - (ends - size)[owner]
    before = np.where(at >= 1, np.roll(symbol, 1), START)
    second = np.where(at >= 2, np.roll(symbol, 2), START)
    return second * SYMBOLS + before, symbol, owner


# --- the model on Spark ------------------------------------------------------------------------------


def _spelled(words: DataFrame, read: Callable[[pa.RecordBatch], Iterator[tuple]]) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Byte transitions of all tables, at most 257 ** 3 cells, added up before they reach the driver; customers and tables.

    ``read`` gives words, customers and tables of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, count = np.array([_CUSTOMERS, _TABLES]), np.zeros(2)
        for batch in batches:
            for names, m, t in read(batch):
                for lo in range(0, len(names), 100_000):
                    context, symbol, owner = transitions(names[lo : lo + 100_000])
                    some, n = t[lo : lo + 100_000], m[lo : lo + 100_000]
                    u, inverse = np.unique(np.concatenate([cell, context * SYMBOLS + symbol]), return_inverse=True)
                    count = np.bincount(inverse, weights=np.concatenate([count, some[owner]]))
                    cell = u
                    count[:2] += n.sum(), some.sum()
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(count.astype(np.int64))], names=["cell", "n"])

    got = words.mapInArrow(tidied(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()
    cell, n = got["cell"].to_numpy(np.int64), got["n"].to_numpy(np.int64)
    totals = dict(zip(cell[cell < 0].tolist(), n[cell < 0].tolist(), strict=True))
    return cell[cell >= 0], n[cell >= 0], totals.get(_CUSTOMERS, 0), totals.get(_TABLES, 0)


_CUSTOMERS, _TABLES = -2, -1


def _cells(*some: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, symbols and counts of cells, added up."""
    cell, n = Spelling._sum(*(np.concatenate(x) for x in zip(*some, strict=True)))
    return cell // SYMBOLS, cell % SYMBOLS, n


class Top:
    """The restaurant without context in one round: what a word's probability takes beside its own numbers."""

    def __init__(self, spelling: Spelling, total: int, tables: int):
        self.spelling, self.total, self.tables = copy(spelling), total, tables
        self.spelling.state = None

    def base(self, words: list[bytes]) -> np.ndarray:
        parts = [np.exp(self.spelling.log_base(words[lo : lo + 50_000])) for lo in range(0, len(words), 50_000)]
        return np.concatenate([np.zeros(0), *parts])

    def predict(self, base: np.ndarray, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        spread = (WORD_STRENGTH + WORD_DISCOUNT * self.tables) * base
        return (customers - WORD_DISCOUNT * tables + spread) / (WORD_STRENGTH + self.total)


#: What the rounds keep and send, one row per bucket. HOME: the words of a bucket with two customers or more (lengths, places, counts,
#: bytes; customers and tables in the restaurant without context, tables of the word's own restaurant, sums of the kept rounds' own
#: tables and probabilities), the buckets of their pairs and which words stand there, as contexts (1) or words (2). PAIRS: the pairs
#: of a bucket (``count_pairs``). REPLY, from words to pairs: probabilities and own tables. TOLD, from pairs to words: how many fewer
#: tables than customers a word has there as context (du) and as word (dw).
_ROUND = "kind int, bucket int, source int, words binary, text binary, data binary, partners array<int>, places array<binary>"
HOME, PAIRS, REPLY, TOLD = range(4)
_WORDS, _SEATS = (np.uint32, np.uint32, np.int64), (np.int64, np.int64, np.int64, np.int64, np.float64)


def _round_rows(rows: list[dict]) -> pa.Table:
    kinds = {
        "kind": pa.int32(), "bucket": pa.int32(), "source": pa.int32(), "words": pa.binary(), "text": pa.binary(), "data": pa.binary(),
        "partners": pa.list_(pa.int32()), "places": pa.list_(pa.binary()),
    }
    return pa.table({k: pa.array([r.get(k) for r in rows], t) for k, t in kinds.items()})


def _of_kind(rows: DataFrame, kind: int) -> DataFrame:
    return rows.where(F.col("kind") == kind)


class Home:
    """A HOME row, opened."""

    def __init__(self, row: dict):
        self.bucket, self.row = row["bucket"], row
        width, self.pos, self.c = _unpack(row["words"], *_WORDS)
        self.names = _cut(width, _unpack(row["text"], np.uint8)[0])
        self.m, self.t, self.own, self.kept, self.p = _unpack(row["data"], *_SEATS)

    @staticmethod
    def begun(bucket: int, names: list[bytes], pos: np.ndarray, c: np.ndarray, partners: list[int], places: list[bytes]) -> Home:
        width, none = np.array([len(w) for w in names], np.uint32), np.zeros(len(c), np.int64)
        words, text = _pack(width, pos.astype(np.uint32), c), _pack(np.frombuffer(b"".join(names), np.uint8))
        data = _pack(c, np.minimum(c, 1), c, none, none.astype(np.float64))
        return Home({"kind": HOME, "bucket": bucket, "words": words, "text": text, "data": data, "partners": partners, "places": places})

    def places(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for partner, data in zip(self.row["partners"], self.row["places"], strict=True):
            yield partner, *_unpack(data, np.uint32, np.uint8)

    def seated(self, told: list[dict], top: Top, keep: bool, rng: np.random.Generator) -> dict:
        """Adds the probabilities so far and the tables to the sums (if ``keep``), takes over what the pairs tell and seats the words anew."""
        base = top.base(self.names)
        kept, p = (self.kept + self.own, self.p + top.predict(base, self.m, self.t)) if keep else (self.kept, self.p)
        news = {x["source"]: x["data"] for x in told}
        m, own = self.c.copy(), self.c.copy()
        for partner, at, _ in self.places():
            du, dw = _unpack(news.pop(partner), np.int64, np.int64)
            own[at] -= du
            m[at] -= dw
        t = seat(m, base, top.tables - self.t, WORD_STRENGTH, WORD_DISCOUNT, rng)
        return self.row | {"data": _pack(m, t, own, kept, p)}


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[Home]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Home(batch.slice(k, 1).to_pylist()[0])


def _tell(bucket: int, known: np.ndarray, data: bytes, buckets: int, first: bool) -> list[dict]:
    """TOLD rows of a bucket of pairs; the first ones name the words."""
    u, w, c, t, _ = _unpack(data, *_PAIR)
    if not len(known):
        return []
    home = (known % np.uint64(buckets)).astype(np.int64)
    du, dw = (np.bincount(x, weights=c - t, minlength=len(known)).astype(np.int64) for x in (u, w))
    role = np.zeros(len(known), np.uint8)
    role[u] |= 1
    role[w] |= 2
    order = np.argsort(home, kind="stable")
    return [
        {"kind": TOLD, "bucket": int(home[x[0]]), "source": bucket, "data": _pack(du[x], dw[x]), "words": _pack(known[x], role[x]) if first else None}
        for x in _runs(order, home[order])
    ]


def _first_told(pairs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, known, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                yield from _round_rows(_tell(bucket, _unpack(known, np.uint64)[0], data, buckets, True)).to_batches()

    return pairs.select("bucket", "word", "data").mapInArrow(tidied(run), _ROUND)


def _begin(words: DataFrame, told: DataFrame, top: Top, number: int, seed: int) -> DataFrame:
    """The first HOME rows, from words with two customers or more and the first TOLD rows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, told = left.sort_by("pos"), right.sort_by("source").to_pylist()
        h = left.column("h").to_numpy().view(np.uint64)
        order, partners, places = np.argsort(h), [], []
        for row in told:
            known, role = _unpack(row["words"], np.uint64, np.uint8)
            partners.append(row["source"])
            places.append(_pack(order[np.searchsorted(h, known, sorter=order)].astype(np.uint32), role))
        bucket = left.column("bucket")[0].as_py()
        home = Home.begun(bucket, left.column("word").to_pylist(), left.column("pos").to_numpy(), left.column("c").to_numpy(), partners, places)
        return _round_rows([home.seated(told, top, False, np.random.default_rng([seed, number, bucket]))])

    return words.select("bucket", "pos", "h", "word", "c").groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(run, _ROUND)


def _seat_words(state: DataFrame, told: DataFrame, top: Top, number: int, keep: bool, seed: int) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        home, told = None, []
        for k in range(rows.num_rows):
            row = rows.slice(k, 1).to_pylist()[0]
            if row["kind"] == HOME:
                home = Home(row)
            else:
                told.append(row)
        return _round_rows([home.seated(told, top, keep, np.random.default_rng([seed, number, home.bucket]))])

    return state.unionByName(told).groupBy("bucket").applyInArrow(run, _ROUND)


def _replies(state: DataFrame, top: Top) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home in _opened(batches):
            p = top.predict(top.base(home.names), home.m, home.t)
            rows = [
                {"kind": REPLY, "bucket": partner, "source": home.bucket, "data": _pack(np.where(role & 2, p[at], 0.0), np.where(role & 1, home.own[at], 0))}
                for partner, at, role in home.places()
            ]
            yield from _round_rows(rows).to_batches()

    return state.mapInArrow(tidied(run), _ROUND)


def _seat_pairs(pairs: DataFrame, replies: DataFrame, number: int, keep: bool, seed: int, buckets: int) -> DataFrame:
    """PAIRS rows seated anew, after the words' replies, and the TOLD rows that come of it."""

    def run(rows: pa.Table) -> pa.Table:
        state = rows.filter(pc.equal(rows.column("kind"), PAIRS)).to_pylist()[0]
        told = rows.filter(pc.equal(rows.column("kind"), REPLY)).sort_by("source").column("data").to_pylist()
        bucket, known = state["bucket"], _unpack(state["words"], np.uint64)[0]
        if not told:
            return _round_rows([state])
        order = np.argsort((known % np.uint64(buckets)).astype(np.int64), kind="stable")
        p, own = np.empty(len(known)), np.empty(len(known), np.int64)
        p[order], own[order] = (np.concatenate(x) for x in zip(*(_unpack(x, np.float64, np.int64) for x in told), strict=True))
        u, w, c, t, kept = _unpack(state["data"], *_PAIR)
        kept = kept + t if keep else kept
        t = seat(c, p[w], own[u] - t, PAIR_STRENGTH, PAIR_DISCOUNT, np.random.default_rng([seed, number, bucket]))
        data = _pair_state(u, w, c, t, kept)
        return _round_rows([state | {"data": data}, *_tell(bucket, known, data, buckets, False)])

    return pairs.unionByName(replies).groupBy("bucket").applyInArrow(run, _ROUND)


class _Tables:
    """Tables written to the shared folder, removed when they have been replaced or read for the last time."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def keep(self, df: DataFrame) -> tuple[DataFrame, str]:
        """The written table is all that is read later, so Spark may remove the shuffle files of the job that made it."""
        path, key = scratch_path(self.spark, "pitman"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(key, before)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def train(words: DataFrame, pairs: DataFrame, rounds: int, burn_in: int, seed: int, buckets: int):
    """From the words and pairs of all buckets: (home, pos, c, p, own) of all words, the pairs' (bucket, data), and how many rounds
    they sum up.

    ``p`` is the word's mean predictive probability without context, ``own`` the mean number of tables of its own restaurant.
    """
    store = _Tables(words.sparkSession)

    def plain(batch: pa.RecordBatch) -> Iterator[tuple]:
        c = batch.column(1).to_numpy()
        yield batch.column(0).to_pylist(), c, np.minimum(c, 1)

    def packed(batch: pa.RecordBatch) -> Iterator[tuple]:
        return ((x.names, x.m, x.t) for x in _opened([batch]))

    *single, once, _ = _spelled(words.where("c = 1").select("word", "c"), plain)
    spelling, rng, tops = Spelling(), np.random.default_rng(seed), []

    def now(rounds: int, rows: DataFrame, read: Callable) -> Top:
        *cells, customers, tables = _spelled(rows, read)
        spelling.gibbs(*_cells(single, cells), rng, rounds)
        return Top(spelling, customers + once, tables + once)

    often = words.where("c > 1")
    top = now(3, often.select("word", "c"), plain)
    state, path = store.keep(_begin(often, _first_told(pairs, buckets), top, 2 * rounds + 1, seed))
    none = {n: F.lit(None).cast(k) for n, k in (x.split() for x in _ROUND.split(", "))}
    seats, seats_path = pairs.select([F.lit(PAIRS).alias("kind"), "bucket", F.col("word").alias("words"), "data"]).withColumns(
        {n: x for n, x in none.items() if n not in ("kind", "bucket", "words", "data")}
    ), None
    for number in range(rounds + 1):
        top, keep = now(1, state, packed), number > burn_in
        if keep:
            tops.append(top)
        if number == rounds:
            break
        made, made_path = store.keep(_seat_pairs(_of_kind(seats, PAIRS), _replies(state, top), 2 * number, keep, seed, buckets))
        fresh, fresh_path = store.keep(_seat_words(state, _of_kind(made, TOLD), top, 2 * number + 1, keep, seed))
        for old in (path, seats_path):
            if old:
                store.drop(old)
        state, path, seats, seats_path = fresh, fresh_path, made, made_path
    n = len(tops)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _opened(batches):
            p = (x.p + tops[-1].predict(tops[-1].base(x.names), x.m, x.t)) / n
            home = pa.array(np.full(len(p), x.bucket), pa.int32())
            yield pa.RecordBatch.from_arrays([home, pa.array(x.pos.astype(np.int64)), pa.array(x.c), pa.array(p), pa.array((x.kept + x.own) / n)], names=names)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, some = batch.column("c").to_numpy(), batch.column("word").to_pylist()
            p = sum(x.predict(x.base(some), c, c) for x in tops) / n
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("home", "pos", "c")), pa.array(p), pa.array(c.astype(np.float64))], names=names)

    names, schema = ["home", "pos", "c", "p", "own"], "home int, pos long, c long, p double, own double"
    rest = words.where("c < 2").select(F.col("bucket").alias("home"), "pos", "word", "c")
    model, _ = store.keep(state.mapInArrow(tidied(seen), schema).unionByName(rest.mapInArrow(tidied(rare), schema)))
    store.drop(path)
    return model, _of_kind(seats, PAIRS).select("bucket", "data"), n


def score(
    docs: DataFrame, rounds: int = ROUNDS, burn_in: int = BURN_IN, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score, score and spelt_score (all log10).

    ``score`` has the outcomes of the base score, the training words and one unknown word, so that their
    perplexities compare; ``spelt_score`` is the probability of the very words, letter by letter where unknown.
    """
    store = _Tables(docs.sparkSession)
    texts = id_and_text(docs, id_col, text_col)
    buckets = 2 * max(1, texts.rdd.getNumPartitions())
    made, _ = store.keep(blocks(texts, buckets))
    words, _ = store.keep(_lists(made, word_lists).groupBy("bucket").applyInArrow(count_words, _BUCKET))
    pairs, _ = store.keep(_lists(made, pair_lists(buckets)).groupBy("bucket").applyInArrow(count_pairs, _BUCKET))
    known = words.where("block IS NULL")
    total, distinct = (x or 0 for x in known.agg(F.sum("c"), F.count(F.when(F.col("c") > 0, 1))).collect()[0])
    model, seated, kept = train(known, pairs.where("block IS NULL"), rounds, burn_in, seed, buckets)
    unknown = max(1.0 - (model.where("c > 0").agg(F.sum("p")).collect()[0][0] or 0.0), 1e-300)
    flat = 0.5 * (distinct + 1) + total

    def of_words(left: pa.Table, right: pa.Table) -> pa.Table:
        pos = right.column("pos").to_numpy()
        c, own, p = (np.empty(len(pos), t) for t in _ANSWER)
        c[pos], p[pos] = (right.column(x).to_numpy() for x in ("c", "p"))
        own[pos] = np.rint(right.column("own").to_numpy() * kept)
        return told(left, 0, [_pack(c[at], own[at], p[at]) for at in places(left)])

    def of_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, c, t, sums = _unpack(right.column("data")[0].as_py(), *_PAIR)
        c, tables = np.append([0, 1], c), np.append([0, kept], sums + t)
        return told(left, 1, [_pack(c[at], tables[at]) for at in places(left)])

    def places(left: pa.Table) -> Iterator[np.ndarray]:
        return (_unpack(x, np.uint32)[0] for x in left.column("data").to_pylist())

    def told(left: pa.Table, kind: int, data: list[bytes]) -> pa.Table:
        kinds = pa.array(np.full(left.num_rows, kind, np.int32))
        return pa.table([left.column("block"), kinds, left.column("bucket"), pa.array(data, pa.binary())], names=["block", "kind", "bucket", "data"])

    schema, route = "block long, kind int, bucket int, data binary", ["bucket", "block", "data"]
    answers = (
        words.where("block IS NOT NULL").select(route).groupBy("bucket").cogroup(model.groupBy("home")).applyInArrow(of_words, schema)
    ).unionByName(
        pairs.where("block IS NOT NULL").select(route).groupBy("bucket").cogroup(seated.groupBy("bucket")).applyInArrow(of_pairs, schema)
    )

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        block, lists = Block(left.to_pylist()[0]), {0: [], 1: []}
        for kind, data in zip(right.column("kind").to_pylist(), right.column("data").to_pylist(), strict=True):
            lists[kind].append(_unpack(data, *(_ANSWER if kind == 0 else _ANSWER[:2])))
        order = np.argsort(block.home, kind="stable")
        c, own, p = (np.empty(len(order), t) for t in _ANSWER)
        c[order], own[order], p[order] = (np.concatenate(x) for x in zip(*lists[0], strict=True))
        pair, at = np.unique(block.code(), return_inverse=True)
        order = pair_order(pair, block.home, buckets)[1]
        customers, tables = (np.concatenate(x) for x in zip(*lists[1], strict=True))
        surplus = np.empty(len(pair))
        surplus[order] = customers - PAIR_DISCOUNT * tables / kept
        del lists, pair, order, customers, tables
        below, free = PAIR_STRENGTH + PAIR_DISCOUNT * own / kept, PAIR_STRENGTH + c
        known, top, base = np.where(c > 0, 1, 0), np.where(c > 0, p, unknown), np.log10((c + 0.5) / flat)
        parts = []
        for texts in block.stretches():
            a, b = block.ends[texts.start] - block.sizes[texts.start], block.ends[texts.stop - 1]
            after, before, more = block.words[a:b], np.append(block.words[a - 1], block.words[a : b - 1]), surplus[at[a:b]]
            some = (known[after], base[after], *(np.log10((more + below[before] * x[after]) / free[before]) for x in (top, p)))
            first = np.append(0, block.ends[texts.start : texts.stop - 1] - a)
            parts.append([np.add.reduceat(x, first) for x in some])
        sums = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return pa.table(
            {
                "doc_id": pa.array(block.ids, pa.int64()), "held_out": block.held, "n_tokens": block.sizes,
                "n_known": sums[0].astype(np.int64), "train_tokens": np.full(len(block.ids), total),
                "base_score": sums[1], "score": sums[2], "spelt_score": sums[3],
            }
        )

    return (
        made.drop("width", "text")
        .groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            solve,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
            "score double, spelt_score double",
        )
    )


#: Of a word: its count in training, the kept rounds' tables of its own restaurant, mean probability without context. Of a pair:
#: its count in training and its tables in the kept rounds.
_ANSWER = (np.int64, np.int64, np.float64)


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, tokens, perplexity, base_perplexity) of training and held-out texts."""
    tokens = F.sum("n_tokens")
    return scored.groupBy("held_out").agg(
        tokens.alias("tokens"),
        F.pow(F.lit(10.0), -F.sum("score") / tokens).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / tokens).alias("base_perplexity"),
    )


@query()
def op5_pitman(spark, sf_dir):
    return score(read(spark, sf_dir, "documents"))
