"""Token packing: shortest-pack-first over the histogram of lengths.

1. Every text becomes token ids plus an end id and is cut at multiples of the sequence length, so
   each text has full pieces and one remainder.
2. Only the histogram of piece lengths - at most one row per length up to the sequence length -
   reaches the driver. Lengths are placed longest first; each goes on top of the emptiest packs
   that still hold it (the shortest packs first), and packs are kept as counted patterns, so the
   work depends on the number of lengths, not of documents.
3. Placements are ranges of ranks within one length. Pieces get their rank from a per-task ordinal
   plus the counts of earlier tasks, and one join on (length, block of ranks) puts them in place.

NULL and empty texts are one piece holding the end id. Repeated rows are packed once each. An empty
table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerlark.llm.common import id_and_text, read, tidied
from ledgerlark.llm.registry import query
from ledgerlark.session import cut_lineage

SEQUENCE = 4096
END_ID = 2
RANKS_PER_BLOCK = 1024
#: A task remembers the ids of this many runs, and of as many that it met before those.
REMEMBERED = 400_000
#: Texts whose lower case and splitting into runs are plain, and the tokenizer's splitting rule for them.
_SIMPLE = re.compile("[\n\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_RUNS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\n\x20a-zß-öø-ÿ0-9]+")
#: A placement table up to this many rows (48 bytes each) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    top = max(tokenizer.get_vocab(with_added_tokens=True).values())
    return tokenizer, [i.to_bytes(4, "little") for i in range(top + 1)]


def word_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Texts to their ids as little-endian unsigned 32-bit bytes; its memory ends with the task.

    The tokenizer drops white space, lowers letters and never merges across white space or across
    the runs of its splitting rule, so the ids of a text are those of its runs one after another. Texts of
    printable ASCII and Latin-1 letters are cut into runs here; others at blanks and line ends only, and
    the rest is left to the tokenizer. Unknown runs are encoded many at a time; a token belongs to the run that
    its offset lies in.
    """
    tokenizer, bytes_of = _tokenizer(path)
    merge = tokenizer.model.tokenize
    young: dict[str, bytes] = {}
    old: dict[str, bytes] = {}

    def learn(unknown: set[str]) -> None:
        young.update((r, old[r]) for r in unknown.intersection(old))
        unknown = unknown.difference(old)
        # Runs of plain small letters pass through normaliser and byte alphabet as they are.
        plain = [r for r in unknown if r.isascii() and r.isalpha() and r.islower()]
        young.update((r, b"".join([bytes_of[t.id] for t in merge(r)])) for r in plain)
        new = list(unknown.difference(plain))
        for lo in range(0, len(new), 1000):
            some = new[lo : lo + 1000]
            encoded = tokenizer.encode("\n".join(some), add_special_tokens=False)
            starts = np.cumsum([0, *(len(w) + 1 for w in some)])
            raw = np.array(encoded.ids, "<u4").tobytes()
            at = (4 * np.searchsorted(np.array([a for a, _ in encoded.offsets], np.int64), starts)).tolist()
            young.update((w, raw[a:b]) for w, a, b in zip(some, at, at[1:], strict=False))

    def encode(texts: list[str]) -> list[bytes]:
        nonlocal young, old
        if len(young) > REMEMBERED:
            young, old = {}, young
        split = [
            _RUNS.findall(t.lower()) if _SIMPLE.fullmatch(t) and "<|" not in t else t.replace("\n", " ").split(" ")
            for t in texts
        ]
        learn(set().union(*split).difference(young))
        return [b"".join(map(young.__getitem__, some)) for some in split]

    return encode


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its length, checksum and ordinal among the task's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        seen = np.zeros(sequence + 1, np.int64)
        width = 4 * sequence
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            for lo in range(0, len(texts), 256):
                for doc, raw in zip(ids[lo : lo + 256], encode([t or "" for t in texts[lo : lo + 256]]), strict=True):
                    raw += end
                    total = len(raw) // 4
                    for at in range(0, len(raw), width):
                        cut = raw[at : at + width]
                        n = len(cut) // 4
                        rows.append((doc, at // 4, n, zlib.crc32(cut), total, task, int(seen[n])))
                        seen[n] += 1
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=PIECE)

    return docs.mapInArrow(tidied(run), ", ".join(f"{n} long" for n in PIECE))


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "ordinal"]


def place(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, count, first sequence, offset) of all pieces.

    Packs of one pattern are a range of sequence numbers. ``open_packs[s]`` lists the ranges whose
    packs have ``s`` tokens left; adding a length to a range moves it to a smaller space, and a range
    longer than needed is split.
    """
    open_packs: dict[int, list[tuple[int, int]]] = {}
    out, next_sequence = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        for space in sorted((s for s in open_packs if s >= length), reverse=True):
            while left and open_packs[space]:
                first, count = open_packs[space].pop()
                take = min(left, count)
                if count > take:
                    open_packs[space].append((first + take, count - take))
                out.append((length, rank, take, first, sequence - space))
                open_packs.setdefault(space - length, []).append((first, take))
                left, rank = left - take, rank + take
            if not open_packs[space]:
                del open_packs[space]
            if not left:
                break
        if left:
            out.append((length, rank, left, next_sequence, 0))
            open_packs.setdefault(sequence - length, []).append((next_sequence, left))
            next_sequence += left
    return out


def pack(
    docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset in the sequence."""
    spark = docs.sparkSession
    cut = cut_lineage(pieces(id_and_text(docs, id_col, text_col), path, sequence, end_id))
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # One row per (length, task): at most `sequence` lengths, each with as many rows as tasks.
    before = F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    starts = per_task.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    ranked = cut.join(starts, ["length", "task"]).withColumn("rank", F.col("before") + F.col("ordinal"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = place(histogram, sequence)
    table = spark.createDataFrame(
        placed, "length long, first_rank long, count long, first_sequence long, offset long"
    ).withColumn(
        "block",
        F.explode(
            F.sequence(
                F.floor(F.col("first_rank") / RANKS_PER_BLOCK),
                F.floor((F.col("first_rank") + F.col("count") - 1) / RANKS_PER_BLOCK),
            )
        ),
    )
    if len(placed) + sum(histogram.values()) // RANKS_PER_BLOCK <= BROADCAST_ROWS:
        table = F.broadcast(table)
    inside = (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("count"))
    return (
        ranked.withColumn("block", F.floor(F.col("rank") / RANKS_PER_BLOCK))
        .join(table, ["length", "block"])
        .where(inside)
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"),
            "offset",
        )
    )


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op10_packing(spark, sf_dir):
    return pack(read(spark, sf_dir, "documents"), vocabulary_path())
