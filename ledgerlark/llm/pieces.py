"""SentencePiece encoding with Gumbel top-k sampling without replacement, and decoding.

The segmentations of a text are the paths through the lattice of the model's pieces. A piece of merge rank r has
weight -alpha * log(r + 2), as a Zipf law over the published order would give it (the model file
holds ranks, no probabilities, and no tokenizer is trained here); a character without a piece is its bytes. The probability of a segmentation
is proportional to the exponential of its summed weights.

Sampling is a best-first search over perturbed regions. The space of all segmentations gets a Gumbel
variable; the best segmentation of a region is drawn from its distribution by walking the lattice with the
exact sums of all continuations, and carries the region's value. What remains of the region falls
apart into regions "same up to word i, other at word i", each with a Gumbel variable of its own
mass, truncated at the value of the whole. The queue gives regions in falling order, so the first k segmentations
are k distinct draws without replacement, and the next value in the queue is the threshold for
inclusion: a segmentation of log probability p is included with probability 1 - exp(-exp(p - threshold)).

Pieces have their blanks first and none holds a line end, so no piece crosses the start of a word, its run of blanks included,
or a line end. So the lattice of a text is a chain of word lattices, which are
built once per batch, for all words of one length together. The model scores pieces of blanks alone with minus a thousand million;
they are weighed by that as a rank.

Random numbers are hashes of seed, row id, round, word and step, so results depend on the row alone,
not on how rows are dealt out. Rows with equal ids draw alike; a NULL id counts as -1. NULL and empty
texts have the one empty segmentation. A text with fewer segmentations than asked for gives them
all, with inclusion 1. An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlark.llm.common import id_and_text, read, slices, tidied
from ledgerlark.llm.registry import query

SAMPLES = 2
ALPHA = 0.5
SEED = 1
_UNIT = re.compile("▁+[^▁\n]*|\n|[^▁\n]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: well spread hashes of counters."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(key: np.ndarray, counter) -> np.ndarray:
    """Numbers in (0, 1) that depend on key and counter alone."""
    x = _mix(key + np.asarray(counter, np.uint64) * _BASE)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Pieces:
    """The model's pieces: weights, a hash table over their code points, and their surfaces."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size = size
        ids, texts = [], []
        self.byte = np.full(256, -1, np.int64)
        surface = [b""] * size
        for i in range(size):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(text[3:5], 16)] = i
                surface[i] = bytes([int(text[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                surface[i] = text.replace("▁", " ").encode()
                if "\n" in text or "▁" in text.lstrip("▁"):
                    raise ValueError("a piece holds a line end, or a blank behind other characters")
                ids.append(i)
                texts.append(text)
        self.weight = np.full(size + 1, -np.inf)
        score = np.array([model.get_score(i) for i in ids])
        self.weight[ids] = -alpha * np.log(np.maximum(-score, 0) + 2)
        self.per_byte = -alpha * np.log(size)
        self.longest = max(map(len, texts))
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        hashes = np.array([self._hash(t) for t in texts], np.uint64)
        self.hash_of = np.zeros(size + 1, np.uint64)
        self.hash_of[ids] = hashes
        self.slots = [np.full(1 << 20, size, np.int32) for _ in range(3)]
        self.turns = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
        left = np.array(ids)
        for slots, turn in zip(self.slots, self.turns, strict=True):
            at = (self.hash_of[left] * turn) >> np.uint64(44)
            slots[at] = left
            left = left[slots[at] != left]
        if len(left):
            raise ValueError("hash table of the pieces is too small")

    @staticmethod
    def _hash(text: str) -> np.uint64:
        h = 0
        for c in text:
            h = (h * int(_BASE) + ord(c) + 1) & (2**64 - 1)
        return np.uint64(h)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes; ``size`` where there is none."""
        out = self.slots[0][(h * self.turns[0]) >> np.uint64(44)]
        # Only where another piece holds the slot can a piece be in a further table.
        other = np.flatnonzero((self.hash_of[out] != h) & (out != self.size))
        for slots, turn in zip(self.slots[1:], self.turns[1:], strict=True):
            out[other] = slots[(h[other] * turn) >> np.uint64(44)]
            other = other[(self.hash_of[out[other]] != h[other]) & (out[other] != self.size)]
        out[other] = self.size
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, with the blank that stands before every text."""
        size = self.lengths[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.surface[at].tobytes()


@cache
def pieces(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


class Lattices:
    """The lattices of a batch's words, as edges of numbered nodes.

    Node ``first[w] + i`` is code point i of word w. Its edges lie from ``edge[node]`` to ``edge[node + 1]``
    with their length in code points, piece, cumulative probability and log probability, the
    longest first. Pieces from ``size`` on stand for characters spelt in several bytes.
    """

    def __init__(self, model: Pieces, words: list[str]):
        self.model = model
        self.spelt: list[bytes] = []
        lens = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(lens) - lens
        self.end = self.first + lens
        total = int(lens.sum())
        parts = []
        order = np.argsort(lens, kind="stable")
        known: dict[int, int] = {}
        for n in np.unique(lens):
            group = order[np.searchsorted(lens[order], n) : np.searchsorted(lens[order], n, side="right")]
            for lo in range(0, len(group), max(1, 400_000 // int(n))):
                some = group[lo : lo + max(1, 400_000 // int(n))]
                raw = "".join([words[w] for w in some.tolist()]).encode("utf-32-le", "surrogatepass")
                parts.append(self._group(some, np.frombuffer(raw, "<u4").reshape(len(some), int(n)), known))
        node = np.concatenate([p[0] for p in parts])
        self.edge = np.append(0, np.cumsum(np.bincount(node, minlength=total)))
        place = self.edge[node] + np.concatenate([p[4] for p in parts])  # by node, the longest first
        self.length, self.piece, self.logp = np.empty(len(node), np.int8), np.empty(len(node), np.int32), np.empty(len(node))
        for to, k in ((self.length, 1), (self.piece, 2), (self.logp, 3)):
            to[place] = np.concatenate([p[k] for p in parts])
        chance = np.exp(self.logp)
        upto = np.cumsum(chance)
        self.upto = upto - np.repeat((upto - chance)[self.edge[:-1]], np.diff(self.edge))
        self.upto[self.edge[1:] - 1] = 2.0  # the last edge takes what rounding leaves

    def _group(self, words: np.ndarray, codes: np.ndarray, known: dict[int, int]):
        model, (count, n) = self.model, codes.shape
        plus = codes.astype(np.uint64) + np.uint64(1)
        prefix = np.zeros((n + 1, count), np.uint64)
        for i in range(n):
            prefix[i + 1] = prefix[i] * _BASE + plus[:, i]
        power = np.cumprod(np.append(np.uint64(1), np.full(model.longest, _BASE)))
        beta = np.zeros((n + 1, count))
        out = []
        base = self.first[words]
        for i in range(n - 1, -1, -1):
            most = min(model.longest, n - i)
            h = prefix[i + 1 : i + most + 1] - prefix[i][None, :] * power[1 : most + 1, None]
            found = model.find(h.ravel()).reshape(h.shape)
            weight = model.weight[found]
            bare = np.flatnonzero(found[0] == model.size)
            for c in np.unique(codes[bare, i]).tolist():
                here = bare[codes[bare, i] == c]
                raw = chr(c).encode("utf-8", "replace")
                if len(raw) == 1:
                    number = int(model.byte[raw[0]])
                else:
                    if c not in known:
                        known[c] = model.size + 1 + len(self.spelt)
                        self.spelt.append(raw)
                    number = known[c]
                found[0, here] = number
                weight[0, here] = model.per_byte * len(raw)
            reach = weight + beta[i + 1 : i + most + 1]
            best = reach.max(axis=0)
            there = found != model.size
            size, word = np.nonzero(there)
            reach = reach[size, word]
            single = np.bincount(word, minlength=count) == 1
            beta[i] = np.where(single, best, best + np.log(np.bincount(word, np.exp(reach - best[word]), count)))
            longer = np.cumsum(there[::-1], axis=0, dtype=np.int8)[::-1][size, word] - 1
            out.append((base[word] + i, size + 1, found[size, word], np.minimum(reach - beta[i][word], 0.0), longer))
        return [np.concatenate([o[k] for o in out]) for k in range(5)]

    def walk(self, words: np.ndarray, keys: np.ndarray):
        """A random path through each word: (pieces, pieces per word, log probability of each)."""
        at, end = self.first[words].copy(), self.end[words]
        logp = np.zeros(len(words))
        count = np.zeros(len(words), np.int64)
        live = np.arange(len(words))
        steps = []
        while len(live):
            u = _uniform(keys[live], len(steps))
            edge = self.edge[at[live]]
            further = np.flatnonzero(u >= self.upto[edge])
            while len(further):
                edge[further] += 1
                further = further[u[further] >= self.upto[edge[further]]]
            logp[live] += self.logp[edge]
            count[live] += 1
            steps.append((live, self.piece[edge]))
            at[live] += self.length[edge]
            live = live[at[live] < end[live]]
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for t, (live, piece) in enumerate(steps):
            out[start[live] + t] = piece
        return out, count, logp

    def _rest(self, first: int, taken: list[np.ndarray], k: int) -> tuple[int, float, float, dict[int, float]]:
        """What ``taken``, paths that agree on their first k edges, leave of the mass from there on:
        (place where they part, mass of leaving before it, mass at it, weights of the edges there)."""
        if len(taken) == 1:
            return len(taken[0]), -float(np.expm1(self.logp[taken[0][k:]].sum())), 0.0, {}
        short = min(map(len, taken))  # paths of one word differ before the shortest of them ends
        same = np.all([t[k:short] == taken[0][k:short] for t in taken[1:]], axis=0)
        part = k + int(np.argmin(same))
        shared = float(self.logp[taken[0][k:part]].sum())
        at = self._node(first, taken[0], part)
        weights = {}
        for e in range(int(self.edge[at]), int(self.edge[at + 1])):
            inner = [t for t in taken if t[part] == e]
            left = 1.0
            if inner:
                _, before, after, _ = self._rest(first, inner, part + 1)
                left = before + after
            weights[e] = float(np.exp(self.logp[e])) * left
        return part, -float(np.expm1(shared)), float(np.exp(shared)) * sum(weights.values()), weights

    def _node(self, first: int, path: np.ndarray, edges: int) -> int:
        """The node that the first edges of a path from node ``first`` lead to."""
        return first + int(self.length[path[:edges]].sum(dtype=np.int64))

    def other(self, word: int, taken: list[np.ndarray], rng: np.random.Generator | None):
        """Log mass of the word's paths without those in ``taken`` (its paths, as edges) and, if ``rng``
        is given, a path drawn from them."""
        first, end = int(self.first[word]), int(self.end[word])
        _, before, after, _ = self._rest(first, taken, 0)
        total = before + after
        if total <= 0:
            return -np.inf, np.empty(0, np.int64)
        if rng is None:
            return float(np.log(total)), np.empty(0, np.int64)
        path, k, left = [], 0, taken
        at = first
        while left:
            part, before, after, weights = self._rest(first, left, k)
            x = rng.random() * (before + after)
            if x < before or not weights:  # leave the shared run, at an edge before ``part``
                gone = -np.expm1(np.cumsum(self.logp[left[0][k:part]]))
                k += min(int(np.searchsorted(gone, x, side="right")), int(np.argmax(gone)))
                path, at = list(left[0][:k]), self._node(first, left[0], k)
                edges = [e for e in range(int(self.edge[at]), int(self.edge[at + 1])) if e != left[0][k]]
                weight, left = np.exp(self.logp[edges]), []
            else:
                path, at = list(left[0][:part]), self._node(first, left[0], part)
                edges, weight, k = list(weights), np.array(list(weights.values())), part + 1
            e = edges[min(int(np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right")), int(np.argmax(np.cumsum(weight))))]
            left = [t for t in left if t[k - 1] == e]
            path.append(e)
            at += int(self.length[e])
        while at < end:
            e = int(self.edge[at])
            x = rng.random()
            while x >= self.upto[e]:
                e += 1
            path.append(e)
            at += int(self.length[e])
        return float(np.log(total)), np.array(path, np.int64)

    def path_of(self, word: int, pieces: np.ndarray) -> np.ndarray:
        """The edges of a word's path, given its pieces."""
        at, out = int(self.first[word]), []
        for p in pieces.tolist():
            lo, hi = int(self.edge[at]), int(self.edge[at + 1])
            e = lo + int(np.flatnonzero(self.piece[lo:hi] == p)[0])
            out.append(e)
            at += int(self.length[e])
        return np.array(out, np.int64)

    def ids(self, pieces: np.ndarray) -> np.ndarray:
        """Model ids: characters spelt in several bytes become their byte pieces."""
        odd = np.flatnonzero(pieces > self.model.size)
        if not len(odd):
            return pieces
        parts, last = [], 0
        for i in odd.tolist():  # few: characters without a piece that need several bytes
            parts += [pieces[last:i], self.model.byte[list(self.spelt[pieces[i] - self.model.size - 1])]]
            last = i + 1
        return np.concatenate([*parts, pieces[last:]])


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _below(limit, mass, u) -> np.ndarray:
    """Gumbel variables of the given log masses, truncated at ``limit``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.isfinite(mass), -np.logaddexp(-limit, -(mass + _gumbel(u))), -np.inf)


def _units(text: str) -> list[str]:
    """Words with the blanks before them, and line ends."""
    if not text:
        return []
    text = "▁" + text.replace(" ", "▁")
    if "\0" in text or "▁▁" in text:
        return _UNIT.findall(text)
    return list(filter(None, text.replace("▁", "\0▁").replace("\n", "\0\n\0").split("\0")))


def sample_batch(model: Pieces, ids: list, texts: list[str], k: int, seed: int):
    """Per text a list of up to k (ids, log probability, perturbed value, log inclusion)."""
    number: dict[str, int] = defaultdict(count().__next__)
    words = []
    for t in texts:
        units = _units(t)
        words.append(np.fromiter(map(number.__getitem__, units), np.int64, len(units)))
    if not number:
        return [[(np.empty(0, np.int64), 0.0, 0.0, 0.0)] for _ in texts]
    lattices = Lattices(model, list(number))
    key = _mix(np.array([hash_key(seed, i) for i in ids], np.uint64))
    docs = np.array([d for d, w in enumerate(words) if len(w)], np.int64)
    out: list[list] = [[] if len(w) else [(np.empty(0, np.int64), 0.0, 0.0, 0.0)] for w in words]
    # Per text: a queue of (value, parent sample, word place, taken paths at that word).
    queue: list[list[tuple]] = [[] for _ in texts]
    drawn: list[list[tuple]] = [[] for _ in texts]  # (pieces, count per word, logp per word) of each sample
    root = _gumbel(_uniform(key, 1 << 40))
    turn = [(int(d), float(root[d]), -1, 0, []) for d in docs]
    for r in range(k):
        # Words after the branching place are free; draw them for all texts at once.
        free = [words[d][j + 1 if p >= 0 else 0 :] for d, _, p, j, _ in turn]
        size = np.array([len(f) for f in free], np.int64)
        owner = np.repeat(np.arange(len(turn)), size)
        offset = np.array([j + 1 if p >= 0 else 0 for _, _, p, j, _ in turn], np.int64)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + offset[owner] if len(owner) else owner
        who = np.array([t[0] for t in turn], np.int64)
        word_key = _mix(key[who][owner] + (place.astype(np.uint64) * np.uint64(64) + np.uint64(r + 1)) * _BASE)
        got, long, logp = lattices.walk(np.concatenate(free) if free else np.empty(0, np.int64), word_key)
        value = np.array([t[1] for t in turn])
        chance = _uniform(word_key, 1 << 41)
        ends, piece_ends = np.cumsum(size), np.cumsum(long)
        next_turn = []
        for t, (d, g, parent, j, taken) in enumerate(turn):
            a, b = int(ends[t] - size[t]), int(ends[t])
            pa_, pb = int(piece_ends[a - 1]) if a else 0, int(piece_ends[b - 1]) if b else 0
            p_new, c_new, l_new = got[pa_:pb], long[a:b], logp[a:b]
            if parent >= 0:
                p_old, c_old, l_old = drawn[d][parent]
                u = _uniform(np.full(2, key[d], np.uint64), (1 << 42) + (r << 32) + j * 2 + np.arange(2, dtype=np.uint64))
                word = int(words[d][j])
                _, path = lattices.other(word, taken, np.random.Generator(np.random.PCG64(int(u[1] * 2**53))))
                before = int(c_old[:j].sum())
                p_new = np.concatenate([p_old[:before], lattices.piece[path], p_new])
                c_new = np.concatenate([c_old[:j], [len(path)], c_new])
                l_new = np.concatenate([l_old[:j], [float(lattices.logp[path].sum())], l_new])
                again = [*taken, path]
                mass, _ = lattices.other(word, again, None)
                if np.isfinite(mass):
                    v = float(_below(g, mass + float(l_old[:j].sum()), u[0]))
                    queue[d].append((v, len(drawn[d]), j, again))
            drawn[d].append((p_new, c_new, l_new))
            out[d].append((p_new, float(l_new.sum()), g))
            # Regions that leave this sample at a later word; only the best k can be needed.
            j0 = len(words[d]) - (b - a)
            if b > a:
                upto = np.cumsum(l_new) - l_new
                with np.errstate(divide="ignore"):
                    mass = upto[j0:] + np.log(-np.expm1(l_new[j0:]))
                v = _below(g, mass, chance[a:b])
                top = np.argpartition(-v, k)[: k + 1] if len(v) > k + 1 else np.arange(len(v))
                queue[d] += [(float(v[i]), len(drawn[d]) - 1, j0 + int(i), None) for i in top if np.isfinite(v[i])]
            queue[d].sort(key=lambda q: (-q[0], q[2]))
            if queue[d] and r + 1 < k:
                v, s, at, paths = queue[d].pop(0)
                if paths is None:  # the one path taken so far is the parent's
                    p, c, _ = drawn[d][s]
                    lo = int(c[:at].sum())
                    paths = [lattices.path_of(int(words[d][at]), p[lo : lo + int(c[at])])]
                next_turn.append((d, v, s, at, paths))
        turn = next_turn
        if not turn:
            break
    for d in docs.tolist():
        limit = queue[d][0][0] if queue[d] else -np.inf
        out[d] = [(lattices.ids(p), lp, g, _log_inclusion(lp - limit)) for p, lp, g in out[d]]
    return out


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x)))"""
    if x < -30:
        return x
    return float(np.log(-np.expm1(-np.exp(min(x, 700.0)))))


def hash_key(seed: int, row: int | None) -> int:
    return (seed * 0x9E3779B97F4A7C15 + (-1 if row is None else row) * 0xD1B54A32D192ED03) & (2**64 - 1)


def sample(
    docs: DataFrame, path: str, k: int = SAMPLES, alpha: float = ALPHA, seed: int = SEED, keep_ids: bool = True,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row up to k segmentations: rank from 1, n_pieces, log_prob, perturbed value, log_inclusion,
    crc32 of the ids (unsigned, little-endian 32 bits), whether they decode to the text, and the ids."""
    names = ["doc_id", "rank", "n_pieces", "log_prob", "perturbed", "log_inclusion", "ids_crc32", "round_trip"]
    schema = (
        "doc_id long, rank int, n_pieces long, log_prob double, perturbed double, log_inclusion double, "
        "ids_crc32 long, round_trip boolean" + (", ids array<int>" if keep_ids else "")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, alpha)
        for whole in batches:
            keys, texts = whole.column(0).to_pylist(), [t or "" for t in whole.column(1).to_pylist()]
            for lo, hi in slices(texts, 2048, 6_000_000):
                rows, lists = [], []
                for i, text, found in zip(
                    keys[lo:hi], texts[lo:hi], sample_batch(model, keys[lo:hi], texts[lo:hi], k, seed), strict=True
                ):
                    raw = (" " + text.replace("▁", " ")).encode() if text else b""
                    for rank, (ids, logp, g, inside) in enumerate(found, start=1):
                        small = ids.astype("<i4")
                        rows.append((i, rank, len(ids), logp, g, inside, zlib.crc32(small.tobytes()), model.decode(ids) == raw))
                        if keep_ids:
                            lists.append(small)
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                columns[0], columns[1] = columns[0].cast(pa.int64()), columns[1].cast(pa.int32())
                if keep_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * keep_ids)

    return id_and_text(docs, id_col, text_col).mapInArrow(tidied(run), schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the ids; NULL stays NULL. A column of that name is replaced."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def text(column):
        model = pieces(path, ALPHA)

        def one(ids):
            return None if ids is None else model.decode(np.asarray(ids, np.int64)).decode("utf-8", "replace")[1:]

        return column.map(one)

    return df.withColumn("decoded", text(ids_col))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query()
def op1_pieces(spark, sf_dir):
    return sample(read(spark, sf_dir, "documents"), model_path())
