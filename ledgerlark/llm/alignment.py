"""Cross-tokenizer alignment: divide and conquer at shared cuts, and how often token pairs overlap in the corpus.

A text, with a blank before it, is encoded by a byte-level vocabulary (A) and by a piece model (B). Both token sequences
spell the same bytes; a byte where a token of each ends is a shared cut.

1. Divide and conquer: an interval of tokens is cut at a common end near its middle, which is located by bisecting B's
   ends with those of A, from the middle outward; both halves go on. Intervals without a common end inside are the
   leaf groups. All intervals of a batch of texts go down level by level together, as arrays; an interval that misses
   tries twice as many ends the next time.
2. Inside a group two tokens are linked if their bytes overlap. The texts' links are written once, packed, as (A id, B id) codes.
3. The links of the corpus are counted per code: tasks add up what they hold, Spark adds up the rest.
4. Each text's links look up their counts. A round broadcasts at most about ``ROUND`` codes, whatever the number of codes in the
   corpus; more codes take more rounds over the packed links, not over the texts.

NULL and empty texts, and texts whose A or B tokens spell other bytes, have no tokens: zeros and an empty digest. Texts of
any length are encoded whole. Ties for the highest count of a B id all count as best. Repeated rows are rows of their
own; rows with a NULL id take part. An empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain, count, islice
from math import ceil

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import id_and_text, read, slices, tidied
from ledgerlark.llm.registry import query
from ledgerlark.session import cut_lineage, scratch_path

#: Codes of a round's broadcast and codes that a counting task holds; neither changes the result.
ROUND, HELD = 4_000_000, 2_000_000
#: Words whose ids a task remembers.
WORDS_KEPT = 300_000

# Fixed value: the words of byte-level vocabularies.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Outside these ranges versions of Unicode differ in what is a letter or a number.
_ELSE = re.compile("[^\x00-\u052f\u2000-\u206f\u20a0-\ua7cd]")
#: Characters of most Latin texts whose classes are beyond doubt, and the words of such texts.
_LATIN = re.compile("[\t-\r -~¡-©«-±´¶-¸»¿-ſ‐-‧]*")
_LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
_LATIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s{_LETTER}0-9]+|\\s+(?!\\S)|\\s+")


# --- token bytes --------------------------------------------------------------------------------


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte that is no visible character as a letter from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordEncoder:
    """Encodes texts by looking up their words; only words not seen lately are encoded.

    ``split`` gives a text's words by a rule over which the vocabulary never joins tokens, or the whole text as one word.
    """

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], list[list[int]]], spelling: list[bytes]):
        self.split, self.encode, self.bytes = split, encode, spelling
        self.size = np.array([len(x) for x in spelling], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.flat, self.start, self.count, self.wrong = array("q"), array("q"), array("q"), array("b")

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        made = self.encode(words)
        count = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter(chain.from_iterable(made), np.int64, int(count.sum()))
        raw = [w.encode("utf-8", "replace") for w in words]
        spelt = b"".join(map(self.bytes.__getitem__, flat.tolist()))
        upto = np.append(0, np.cumsum(self.size[flat]))[np.cumsum(count)]
        wrong = np.diff(upto, prepend=0) != np.fromiter(map(len, raw), np.int64, len(raw))
        if wrong.any() or spelt != b"".join(raw):
            wrong = [spelt[a:b] != r for a, b, r in zip([0, *upto[:-1].tolist()], upto.tolist(), raw, strict=True)]
        self.start.frombytes((len(self.flat) + np.cumsum(count) - count).tobytes())
        self.count.frombytes(count.tobytes())
        self.flat.frombytes(flat.tobytes())
        self.wrong.frombytes(np.asarray(wrong, np.int8).tobytes())

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, ids per text, and whether they spell the text."""
        if len(self.number) > WORDS_KEPT:
            self._forget()
        words, each = [], []
        for t in texts:
            some = self.split(t)
            some = some if sum(map(len, some)) == len(t) else [t]
            words += some
            each.append(len(some))
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self._learn(list(islice(self.number, len(self.start), None)))  # the words that have just got a number
        count = np.frombuffer(self.count, np.int64)[at]
        upto = np.cumsum(count)
        place = np.repeat(np.frombuffer(self.start, np.int64)[at] - upto + count, count) + np.arange(upto[-1])
        last = np.cumsum(each)
        wrong = np.add.reduceat(np.frombuffer(self.wrong, np.int8)[at].astype(np.int64), last - each)
        return np.frombuffer(self.flat, np.int64)[place], np.diff(upto[last - 1], prepend=0), wrong == 0


def level_encoder(path: str) -> WordEncoder:
    """For a byte-level vocabulary file, which never joins words.

    Texts with characters that the two pattern libraries may class differently, and files with another rule, stay whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    byte = byte_of_char()
    spelling = [b""] * made.get_vocab_size()
    for token, i in made.get_vocab().items():
        spelling[i] = bytes(byte.get(c, 63) for c in token)
    rule = json.loads(made.to_str())
    how = rule["pre_tokenizer"] or {}
    plain = not rule["normalizer"] and not rule["post_processor"] and how.get("type") == "ByteLevel"
    by_word = plain and how.get("use_regex") and not how.get("add_prefix_space")
    find = regex.compile(_WORDS).findall

    def split(text: str) -> list[str]:
        if by_word and _LATIN.fullmatch(text):
            return _LATIN_WORDS.findall(text)
        return find(text) if by_word and not _ELSE.search(text) else [text]

    return WordEncoder(split, lambda words: [e.ids for e in made.encode_batch_fast(words, add_special_tokens=False)], spelling)


def piece_encoder(path: str) -> WordEncoder:
    """For a piece model file, which adds the blank that the texts here begin with.

    If no piece has a blank behind another character, none reaches over the start of a run of blanks. Models that have such a
    piece, or change what they read, take texts whole.
    """
    from sentencepiece import SentencePieceProcessor

    made = SentencePieceProcessor(model_file=path)
    pieces = [made.id_to_piece(i) for i in range(made.get_piece_size())]
    spelling = [bytes([int(p[3:5], 16)]) if made.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    probe = "  ﬁ  Ａ e\u0301 \u3000\tx  "
    blank = made.piece_to_id("▁")
    by_word = pieces[blank] == "▁" and not any(re.search("[^▁]▁", p) for p in pieces)
    by_word = by_word and made.normalize(probe) == "▁" + probe.replace(" ", "▁")
    find = re.compile(" *[^ ]+| +").findall

    def split(text: str) -> list[str]:
        return find(text) if by_word and "▁" not in text else [text]

    def encode(words: list[str]) -> list[list[int]]:
        return [ids or [blank] for ids in made.encode([w[1:] for w in words], num_threads=1)]

    return WordEncoder(split, encode, spelling)


# --- divide and conquer -------------------------------------------------------------------------


def _ends_before(ends: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` bytes how many ends lie before it."""
    here = np.bincount(ends, minlength=size)
    return np.cumsum(here) - here


def groups(ends_a: np.ndarray, ends_b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B up to the end of each group, in order.

    ``ends`` are the bytes up to each token's end over all texts; ``upto`` the tokens up to the end of each text.
    """
    lo_a, hi_a = np.append(0, upto_a[:-1]), upto_a
    lo_b, hi_b = np.append(0, upto_b[:-1]), upto_b
    tried = np.zeros(len(hi_a), np.int64)
    before_b = _ends_before(ends_b, int(ends_a[-1]) + 1)
    done_a, done_b = [], []
    while len(lo_a):
        inner = hi_a - lo_a - 1  # ends of A inside the interval
        leaf = (tried >= inner) | (hi_b - lo_b < 2)
        done_a.append(hi_a[leaf])
        done_b.append(hi_b[leaf])
        lo_a, hi_a, lo_b, hi_b, tried, inner = (x[~leaf] for x in (lo_a, hi_a, lo_b, hi_b, tried, inner))
        if not len(lo_a):
            break
        width = np.minimum(inner - tried, np.maximum(tried, 1))
        at = np.repeat(np.arange(len(lo_a)), width)
        first = np.cumsum(width) - width
        step = tried[at] + np.arange(len(at)) - first[at]
        end = lo_a[at] + (inner[at] - 1) // 2 + np.where(step % 2, (step + 1) // 2, -(step // 2))
        other = before_b[ends_a[end]]
        hit = ends_b[other] == ends_a[end]
        best = np.minimum.reduceat(np.where(hit, np.arange(len(at)), len(at)), first)
        cut = best < len(at)
        a, b = end[best[cut]] + 1, other[best[cut]] + 1
        miss = ~cut
        lo_a, hi_a, lo_b, hi_b, tried = (
            np.concatenate([lo_a[miss], lo_a[cut], a]), np.concatenate([hi_a[miss], a, hi_a[cut]]),
            np.concatenate([lo_b[miss], lo_b[cut], b]), np.concatenate([hi_b[miss], b, hi_b[cut]]),
            np.concatenate([(tried + width)[miss], np.zeros(2 * len(a), np.int64)]),
        )
    return np.sort(np.concatenate(done_a)), np.sort(np.concatenate(done_b))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the tokens of A and B that overlap: one pair for each stretch between two ends of either."""
    size = int(max(ends_a[-1], ends_b[-1])) + 1
    either = np.zeros(size, bool)
    either[ends_a] = either[ends_b] = True
    ends = np.flatnonzero(either)
    return _ends_before(ends_a, size)[ends], _ends_before(ends_b, size)[ends]


class Aligner:
    """Both vocabularies; aligns some texts at a time."""

    def __init__(self, path_a: str, path_b: str):
        self.encode_a, self.encode_b = level_encoder(path_a), piece_encoder(path_b)
        self.bytes_a, self.bytes_b = self.encode_a.bytes, self.encode_b.bytes
        self.size_a, self.size_b = (np.array([len(x) for x in y]) for y in (self.bytes_a, self.bytes_b))
        self.written = [b"%d%s" % (i, s) for n, ends in ((len(self.bytes_a), b",|"), (len(self.bytes_b), b",;")) for s in (ends[:1], ends[1:]) for i in range(n)]

    def __call__(self, texts: list[str]) -> list[tuple[int, int, int, int, str, np.ndarray]]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, codes in ascending order) per text."""
        out = [(0, 0, 0, 0, "", np.empty(0, np.int64))] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        plain = [" " + texts[i] for i in some]
        if not some:
            return out
        (ids_a, n_a, right_a), (ids_b, n_b, right_b) = self.encode_a(plain), self.encode_b(plain)
        kept = right_a & right_b
        if not kept.all():
            ids_a, ids_b = ids_a[np.repeat(kept, n_a)], ids_b[np.repeat(kept, n_b)]
            n_a, n_b, some = n_a[kept], n_b[kept], [i for i, k in zip(some, kept.tolist(), strict=True) if k]
            if not some:
                return out
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        cut_a, cut_b = groups(ends_a, ends_b, upto_a, upto_b)
        digest = self._digests(ids_a, ids_b, cut_a, cut_b, upto_a + upto_b)
        at_a, at_b = links(ends_a, ends_b)
        codes = ids_a[at_a] * len(self.bytes_b) + ids_b[at_b]
        n_groups = np.diff(np.searchsorted(cut_a, upto_a, side="right"), prepend=0)
        upto = np.searchsorted(at_a, upto_a)
        for k, (i, lo, hi) in enumerate(zip(some, np.append(0, upto[:-1]).tolist(), upto.tolist(), strict=True)):
            out[i] = (int(n_a[k]), int(n_b[k]), int(n_groups[k]), hi - lo, digest[k], np.sort(codes[lo:hi]))
        return out

    def _digests(self, ids_a, ids_b, cut_a, cut_b, upto) -> list[str]:
        """Digest of each text's groups; the tokens of a group stand together, those of A first."""
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[cut_a - 1], last_b[cut_b - 1] = 1, 1
        group_a, group_b = (np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in (cut_a, cut_b))
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        order[np.arange(len(ids_a)) + np.append(0, cut_b)[group_a]] = ids_a + n_a * last_a
        order[np.arange(len(ids_b)) + cut_a[group_b]] = 2 * n_a + ids_b + n_b * last_b
        token = self.written.__getitem__
        return [
            sha256(b"".join(map(token, order[lo:hi].tolist()))[:-1]).hexdigest()
            for lo, hi in zip(np.append(0, upto[:-1]).tolist(), upto.tolist(), strict=True)
        ]


# --- packed links -------------------------------------------------------------------------------


def packed(codes: np.ndarray) -> bytes:
    """Ascending codes as steps, byte planes apart, compressed."""
    steps = np.diff(codes, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(steps).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<i8").ravel())


def _aligned(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per text its row number, the figures of its groups and its packed links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, row = Aligner(path_a, path_b), TaskContext.get().partitionId() << 40
        for whole in batches:
            many = [t or "" for t in whole.column(1).to_pylist()]
            for lo, hi in slices(many, chars=1_000_000):
                *figures, codes = zip(*align(many[lo:hi]), strict=True)
                made = [pa.array(f, pa.string() if k == 4 else pa.int64()) for k, f in enumerate(figures)]
                rows = pa.array(np.arange(row, row + hi - lo))
                row += hi - lo
                data = pa.array([packed(c) if len(c) else None for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([rows, whole.column(0).slice(lo, hi - lo), *made, data], names=names)

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
    return texts.mapInArrow(tidied(run), schema)


def _tally(some: list[np.ndarray], count: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their summed counts."""
    codes, counts = np.concatenate(some), np.concatenate(count)
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.empty(0, np.int64)
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


def code_counts(stored: DataFrame) -> DataFrame:
    """(code, n): the corpus-wide count of each pair of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, size = [], [], 0
        for batch in batches:
            for data in batch.column(0).drop_null():
                codes.append(unpacked(data.as_py()))
                counts.append(np.ones(len(codes[-1]), np.int64))
                size += len(codes[-1])
                if size > 2 * HELD:
                    codes, counts = ([x] for x in _tally(codes, counts))
                    size = len(codes[0])
                    if size > HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(codes[0]), pa.array(counts[0])], names=["code", "n"])
                        codes, counts, size = [], [], 0
        if codes:
            found = _tally(codes, counts)
            for lo in range(0, len(found[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 100_000]) for x in found], names=["code", "n"])

    return stored.select("links").mapInArrow(tidied(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _looked_up(stored: DataFrame, codes: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of each text's links among some (code, n, best)."""
    table = codes.select("code", "n", "best").toArrow()
    code, n, best = (table.column(c).to_numpy() for c in ("code", "n", "best"))
    order = np.argsort(code)
    shared = stored.sparkSession.sparkContext.broadcast((code[order], n[order], best[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = shared.value
        for batch in batches:
            found = []
            for data in batch.column(1):
                mine = unpacked(data.as_py())
                at = np.minimum(np.searchsorted(code, mine), len(code) - 1)
                at = at[code[at] == mine]
                found.append((int(best[at].sum()), int(n[at].sum())))
            made = [pa.array([f[k] for f in found], pa.int64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["row", "n_best", "count_sum"])

    some = stored.where("links IS NOT NULL").select("row", "links")
    return some.mapInArrow(tidied(run), "row long, n_best long, count_sum long")


def align(
    docs: DataFrame, path_a: str, path_b: str, per_round: int = ROUND, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per text: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    spark = docs.sparkSession
    path = scratch_path(spark, "links")
    _aligned(id_and_text(docs, id_col, text_col), path_a, path_b).write.parquet(path)
    stored = spark.read.parquet(path)
    n_b = len(piece_encoder(path_b).bytes)
    counts = cut_lineage(code_counts(stored))
    b = F.pmod("code", F.lit(n_b))
    top = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # as many rows as the vocabulary has ids, at most
    codes = counts.join(F.broadcast(top), b == F.col("b")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    rounds = ceil(counts.count() / per_round)
    sums = spark.createDataFrame([], "row long, n_best long, count_sum long")
    for r in range(rounds):
        mine = F.pmod(F.xxhash64("code"), F.lit(rounds)) == r
        sums = sums.unionByName(_looked_up(stored, codes.where(mine)))
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = stored.drop("links").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query()
def op12_alignment(spark, sf_dir):
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align(read(spark, sf_dir, "documents"), *paths)
