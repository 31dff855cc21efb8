"""Alignment of two tokenizers against brute force over all pairs of tokens."""

import bisect
import collections
import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

from ledgerlark.llm import alignment

sys.path.insert(0, str(Path(__file__).parent))
from cases import frame, odd_rows, prose  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain_tokens(texts):
    import base64

    import sentencepiece
    import tiktoken

    lines = map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    for t in texts:
        left = [(i, a.decode_single_token_bytes(i)) for i in a.encode_ordinary(" " + (t or ""))]
        right = []
        for i in b.encode(t or ""):
            p = b.id_to_piece(i)
            right.append((i, bytes.fromhex(p[3:5]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()))
        whole = b" " + (t or "").encode()
        if not t or b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            left = right = []
        yield left, right


def plain_align(rows):
    """The result of (doc_id, text) rows, pair by pair of tokens."""
    found, count = [], collections.Counter()
    for (i, _), (left, right) in zip(rows, plain_tokens([t for _, t in rows]), strict=True):
        spans = []
        for tokens in (left, right):
            at, some = 0, []
            for k, x in tokens:
                some.append((at, at + len(x), k))
                at += len(x)
            spans.append(some)
        ends = sorted({x[1] for x in spans[0]} & {x[1] for x in spans[1]})
        groups = [([], []) for _ in ends]
        for side, some in enumerate(spans):
            for _, hi, k in some:
                groups[bisect.bisect_left(ends, hi)][side].append(k)
        starts = [x[0] for x in spans[1]]
        pairs = []
        for lo, hi, k in spans[0]:
            j = bisect.bisect_right(starts, lo) - 1
            while j < len(starts) and starts[j] < hi:
                pairs.append((k, spans[1][j][2]))
                j += 1
        count.update(pairs)
        digest = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        found.append((i, len(left), len(right), len(ends), pairs, hashlib.sha256(digest.encode()).hexdigest() if left else ""))
    best = collections.defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(
        ((i, a, b, g, len(p), sum(count[x] == best[x[1]] for x in p), sum(count[x] for x in p), h) for i, a, b, g, p, h in found),
        key=str,
    )


@pytest.mark.parametrize("per_round", [alignment.ROUND, 700])
def test_align(spark, per_round):
    rows = [r[:2] for r in odd_rows()]
    rows += [(20, "<|endoftext|> <s></s> <unk> ▁ a"), (21, "▁▁"), (22, "naïve café 中文 🎉🎉 \x07"), (23, "  two  blanks\n\n\n"), (24, prose(300, 9).upper())]
    got = alignment.align(frame(spark, [(*r, *["clash"] * 14) for r in rows]), *PATHS, per_round=per_round)
    assert got.columns == FIELDS
    assert sorted(map(tuple, got.collect()), key=str) == plain_align(rows)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    plain = plain_align(rows)
    assert sorted(map(tuple, alignment.op12_alignment(spark, SF_DIR).collect()), key=str) == plain
    assert sum(r[5] for r in plain) > 0 and sum(r[3] for r in plain) < sum(r[4] for r in plain)


def test_align_empty(spark):
    assert alignment.align(frame(spark, []), *PATHS).collect() == []


def test_groups():
    r = random.Random(3)
    for _ in range(300):
        texts = [r.randrange(1, 60) for _ in range(r.randrange(1, 6))]
        sides, upto = [], []
        for rate in (r.random(), r.random()):
            ends, at, many = [], 0, []
            for n in texts:
                ends += [at + i for i in range(1, n) if r.random() < rate] + [at + n]
                at += n
                many.append(len(ends))
            sides.append(np.array(ends))
            upto.append(np.array(many))
        cut_a, cut_b = alignment.groups(*sides, *upto)
        common = sorted(set(sides[0].tolist()) & set(sides[1].tolist()))
        assert sides[0][cut_a - 1].tolist() == common == sides[1][cut_b - 1].tolist()


def test_packed_codes():
    codes = np.array([0, 0, 5, 5, 1_608_223_999, 10**15])
    assert alignment.unpacked(alignment.packed(codes)).tolist() == codes.tolist()


def test_latin_words_are_the_rule():
    """The plain pattern for Latin texts cuts as the vocabulary's rule does, and takes no other text."""
    import regex

    chars = [chr(c) for c in range(0x3000) if alignment._LATIN.fullmatch(chr(c))]
    assert len(chars) > 300 and not {"\x1c", "\xa0", "\x85", "ª", "²", "\u2003", "\u2028", "Ω"} & set(chars)
    for c in chars:
        for text in (c, f"a{c}b", f" {c}{c} ", f"1{c}2", f"-{c}\n", f"{c}  x", f"it's{c}'ll"):
            assert alignment._LATIN_WORDS.findall(text) == regex.findall(alignment._WORDS, text)


def test_words_with_another_spelling_are_found():
    """Among words learnt together, those whose ids spell something else are told apart."""
    encoder = alignment.WordEncoder(lambda t: t.split("|"), lambda words: [[0, 1] if w == "xy" else [2] for w in words], [b"x", b"y", b"z"])
    ids, count, right = encoder(["xy", "q", "z", "zz"])
    assert (ids.tolist(), count.tolist(), right.tolist()) == ([0, 1, 2, 2, 2], [2, 1, 1, 1], [True, False, True, False])


def test_words_are_looked_up_once():
    """An encoder hashes every word of a text once, and a new word once more to encode it."""
    looked = []

    class Word(str):
        def __hash__(self):
            looked.append(self)
            return super().__hash__()

    encode = alignment.WordEncoder(lambda t: [Word(w) for w in re.findall(" [^ ]*", t)], lambda many: [list(w.encode()) for w in many], [bytes([i]) for i in range(256)])
    texts = [" a bc a", " bc", " d a a"]
    for new in (3, 0):
        looked.clear()
        ids, count, right = encode(texts)
        assert bytes(ids.tolist()).decode() == "".join(texts) and count.tolist() == list(map(len, texts)) and right.all()
        assert len(looked) <= 7 + new
