"""Packing, near-duplicates, nearest neighbours, segmentations, language model, quality and the pipeline against brute force."""

import collections
import math
import re
import sys
import uuid
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from cases import frame, lower, odd_rows, prose, words  # noqa: E402

import corpus_pipeline
from ledgerlark.llm import nearest, packing, pieces, pii, pitman, quality, simhash

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# --- packing -----------------------------------------------------------------------------------------


def check_packing(rows, texts, sequence):
    """Every id in one piece, sequences gapless and at most full."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    ids = collections.Counter()
    for i, t in texts:
        ids[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)] += 1
    by_doc = collections.defaultdict(list)
    for (i, x), n in ids.items():
        by_doc[i] += [x] * n
    left = collections.Counter()
    for i, many in by_doc.items():
        for x in many:
            for at in range(0, len(x), sequence):
                cut = x[at : at + sequence]
                left[i, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), len(x)] += 1
    assert left == collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    packs = collections.defaultdict(list)
    for r in rows:
        packs[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces_ in packs.values():
        pieces_.sort()
        assert [a for a, _ in pieces_] == [sum(n for _, n in pieces_[:k]) for k in range(len(pieces_))]
        assert sum(n for _, n in pieces_) <= sequence
    return 1 - sum(r["length"] for r in rows) / (len(packs) * sequence)


def test_packing_whole_table(spark, documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows = packing.op10_packing(spark, SF_DIR).collect()
    assert check_packing(rows, texts, 4096) < 0.05


def test_packing_odd_rows(spark):
    rows = odd_rows()
    got = packing.pack(frame(spark, rows), packing.vocabulary_path(), sequence=64).collect()
    check_packing(got, [(r[0], r[1]) for r in rows], 64)


def test_placement_is_shortest_first():
    placed = packing.place({6: 1, 5: 2, 3: 3, 2: 1}, 8)
    assert placed == [(6, 0, 1, 0, 0), (5, 0, 2, 1, 0), (3, 0, 2, 1, 5), (3, 2, 1, 3, 0), (2, 0, 1, 3, 3)]
    rng = np.random.default_rng(0)
    histogram = {int(n): int(rng.integers(1, 50)) for n in rng.integers(1, 65, 30)}
    used = collections.Counter()
    for length, rank, count, first, offset in packing.place(histogram, 64):
        for s in range(first, first + count):
            assert offset == used[s] and used[s] + length <= 64
            used[s] += length
    assert sum(used.values()) == sum(k * v for k, v in histogram.items())


def test_word_encoder_equals_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    encode = packing.word_encoder(packing.vocabulary_path())
    odd = ["a b c\x85d\x1ce f", "don't it's  we'll\tx\r\ny", "<|endoftext|>x <|startoftext|> a<|endoftext|>", "é ́x İ ΣΣ ẞ", "",
           "it's's ''ll !'s a'd're <|x 1a2b3c A1B x_y-z", "\x1fab \x7f q\x0bz", "日本語 ﷺ ﬁ Å ①2", prose(500, 7)]
    for text, raw in zip(odd, encode(odd), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# --- near-duplicates -----------------------------------------------------------------------------------


def plain_fingerprint(text):
    some = words(lower(text))
    if not some:
        return 0
    shingles = [" ".join(some[i : i + 3]) for i in range(max(1, len(some) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, radius):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in root}


def test_simhash_whole_table(spark, documents):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in documents.collect()]
    groups = plain_groups({f for _, f in rows}, 2)
    least = {}
    for i, f in rows:
        least[groups[f]] = min(i, least.get(groups[f], i))
    want = sorted((i, f"{f:016x}", least[groups[f]]) for i, f in rows)
    got = simhash.op6_simhash(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_near_copies_share_a_group(spark):
    text = prose(4000, 11)
    rows = [(1, text, *["x"] * 14), (2, text.upper(), *["x"] * 14), (3, text + " end", *["x"] * 14), (4, prose(4000, 12), *["x"] * 14)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.grouped(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


@pytest.mark.parametrize("radius, segments, bucket", [(2, 16, 4), (2, 16, 256), (3, 8, 16), (0, 4, 2)])
def test_links_connect_all_pairs(spark, radius, segments, bucket):
    rng = np.random.default_rng(radius)
    values = {0, 2**64 - 1}
    for center in rng.integers(0, 2**63, 6).tolist():
        for _ in range(60):
            v = center
            for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                v ^= 1 << b
            values.add(v)
    nodes = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp long")
    edges = simhash.links(nodes, radius, segments, bucket)
    got = {r["node"] % 2**64: r["root"] % 2**64 for r in simhash.components(spark, edges).collect()}
    want = plain_groups(values, radius)
    parts = lambda m: {frozenset(v for v in values if m.get(v, v) == m.get(r, r)) for r in values}
    assert parts(got) == parts(want)


def test_pigeonring_never_rejects():
    """Every pair within the radius passes the chain of some start."""
    rng = np.random.default_rng(3)
    ring = simhash.Ring(2, 16)
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        b = a
        for k in rng.integers(0, 63, rng.integers(0, 3)).tolist():
            b ^= 1 << k
        x = [np.full(16, v, np.int64) for v in (a, b)]
        assert ring.links(*x, np.arange(16)).any()


# --- nearest neighbours --------------------------------------------------------------------------------


def plain_nearest(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 3:
            good[i, tuple(v)] = np.array(v, np.float32).astype(np.float64)
    out = {}
    for (i, _), q in good.items():
        if i % 20 == 0:
            found = sorted((-float((q * v).sum()), j) for (j, _), v in good.items() if j != i)
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def test_nearest_small_and_odd(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(1, 60)]
    rows += [(60, rows[4][1]), (61, rows[4][1]), (40, rows[39][1]), (80, None), (81, [0.0, 0.0, 0.0]), (82, [1.0, None, 2.0])]
    rows += [(83, [float("nan"), 1.0, 1.0]), (84, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (85, [1.0]), (86, [])]
    rows += [(90 + i, rows[4][1]) for i in range(30)]
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, v string, task int")
    found = nearest.search(table, F.col("vec_id") % 20 == 0, steps=6).collect()
    want = plain_nearest(rows, 20)
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert set(got) == set(want)
    hits = 0
    for q, mine in got.items():
        exact = dict(want[q])
        everything = {j: s for j, s in plain_nearest(rows, 10**6)[q]}
        assert all(abs(everything[j] - s) < 1e-12 for j, s in mine)
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0])) and len(mine) == 20
        hits += len(set(exact) & {j for j, _ in mine})
    assert hits >= 0.9 * 20 * len(got)
    copies = [j for j, _ in got[60]]
    assert 60 not in copies and copies[:3] == [5, 61, 90]
    assert nearest.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = nearest.search(table.where("vec_id in (20, 21)"), F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(20, 1, 21)]


def test_nearest_recall(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    vectors, ids = np.array(rows["embedding"].tolist(), np.float64), rows["vec_id"].to_numpy()
    found = collections.defaultdict(set)
    for r in nearest.op9_nearest(spark, SF_DIR).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[i]
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        hits, total = hits + len(found[ids[i]] & set(best)), total + 20
    assert hits / total >= 0.9


# --- segmentations -------------------------------------------------------------------------------------


def plain_segmentations(model, word):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    weight = {processor.id_to_piece(i): (i, model.weight[i]) for i in range(model.size) if np.isfinite(model.weight[i])}
    text, out = "▁" + word.replace(" ", "▁"), {}

    def follow(at, ids, w):
        if at == len(text):
            out[tuple(ids)] = w
            return
        for n in range(1, 17):
            piece = text[at : at + n]
            if at + n <= len(text) and piece in weight:
                follow(at + n, [*ids, weight[piece][0]], w + weight[piece][1])
        if text[at] not in weight:
            raw = text[at].encode()
            follow(at + 1, [*ids, *(int(model.byte[b]) for b in raw)], w + model.per_byte * len(raw))

    follow(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: float(np.exp(v - total)) for k, v in out.items()}


@pytest.mark.parametrize("word", ["the ab", "x☃①b\nq", "hel", "a  b"])
def test_sampling_without_replacement(word):
    model = pieces.pieces(pieces.model_path(), 0.5)
    p = plain_segmentations(model, word)
    n = 3000
    out = pieces.sample_batch(model, list(range(n)), [word] * n, 3, 7)
    first, second, inverse = collections.Counter(), collections.Counter(), 0.0
    for found in out:
        ids = [tuple(x[0].tolist()) for x in found]
        assert len(set(ids)) == len(ids) == min(3, len(p))
        assert all(abs(math.log(p[i]) - x[1]) < 1e-9 for i, x in zip(ids, found, strict=True))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:], strict=False))
        first[ids[0]] += 1
        if len(ids) > 1:
            second[ids[1]] += 1
        inverse += sum(math.exp(x[1] - x[3]) for x in found) / n
    assert sum(abs(first[k] / n - v) for k, v in p.items()) / 2 < 0.05
    want = {j: sum(p[i] * p[j] / (1 - p[i]) for i in p if i != j) for j in p} if len(p) > 1 else {}
    assert sum(abs(second[k] / n - v) for k, v in want.items()) / 2 < 0.05
    assert abs(inverse - 1) < 0.05  # inclusion scores make sums over samples unbiased


def test_pieces_of_several_blanks():
    """Every piece of the model that is no control and no byte stands in the lattice."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    model = pieces.pieces(pieces.model_path(), 0.5)
    text = "a\n" + "b".join(" " * n for n in range(2, 8)) + "b "
    whole = plain_segmentations(model, "a" + " " * 6 + "b")
    assert any(processor.piece_to_id("▁" * 6) in ids for ids in whole)
    found = pieces.sample_batch(model, list(range(400)), [text] * 400, 2, 3)
    used = {i for some in found for ids, *_ in some for i in ids.tolist()}
    assert {processor.piece_to_id("▁" * n) for n in (2, 3, 4, 5, 6)} <= used
    assert all(model.decode(ids) == (" " + text).encode() for some in found for ids, *_ in some)


def test_lattice_weighs_its_edges_alone(monkeypatch):
    """Exponentials are taken of edges, not of all places where a piece could have been; edges stand longest first."""
    model, taken, plain = pieces.pieces(pieces.model_path(), pieces.ALPHA), [], np.exp
    monkeypatch.setattr(np, "exp", lambda x: taken.append(np.size(x)) or plain(x))
    some = ["▁" + w for w in words(lower(prose(3000, 5)))] + ["▁é世", "\n", "▁" * 9 + "a"]
    made = pieces.Lattices(model, some)
    assert sum(taken) <= 2 * len(made.length)
    assert made.edge[0] == 0 and made.edge[-1] == len(made.length) and len(made.edge) == sum(map(len, some)) + 1
    for lo, hi in zip(made.edge[:-1].tolist(), made.edge[1:].tolist(), strict=True):
        assert (np.diff(made.length[lo:hi]) < 0).all() and plain(made.logp[lo:hi]).sum() == pytest.approx(1)
    for w, text in enumerate(some):
        for at, char in enumerate(text, start=int(made.first[w])):
            last = int(made.edge[at + 1]) - 1
            assert made.length[last] == 1
            number = int(made.piece[last])
            assert number >= model.size or model.surface[model.starts[number] : model.starts[number] + model.lengths[number]].tobytes().decode() == char.replace("▁", " ")


def test_pieces_query_gives_the_segmentations(spark):
    rows = pieces.decode(pieces.op1_pieces(spark, SF_DIR), pieces.model_path()).select("doc_id", "rank", "ids", "n_pieces", "ids_crc32", "decoded").collect()
    texts = {r["doc_id"]: (r["text"] or "").replace("▁", " ") for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert all(r["decoded"] == texts[r["doc_id"]] and len(r["ids"]) == r["n_pieces"] for r in rows)
    assert all(zlib.crc32(np.array(r["ids"], "<i4").tobytes()) == r["ids_crc32"] for r in rows)
    assert {r["doc_id"] for r in rows if r["rank"] == 1} == set(texts)


def test_pieces_decode_and_repeat(spark):
    rows = odd_rows()
    d = frame(spark, rows)
    got = pieces.decode(pieces.sample(d, pieces.model_path()), pieces.model_path()).collect()
    texts = collections.defaultdict(set)
    for r in rows:
        texts[r[0]].add((r[1] or "").replace("▁", " "))
    assert all(r["round_trip"] and r["decoded"] in texts[r["doc_id"]] for r in got)
    assert {r["doc_id"] for r in got} == {r[0] for r in rows}
    six = [r for r in got if r["doc_id"] == 6]
    assert six[0]["ids"] in [r["ids"] for r in six[1:]]
    again = pieces.sample(d.repartition(3), pieces.model_path()).collect()
    key = lambda r: (str(r["doc_id"]), r["rank"], r["ids"])
    assert sorted(map(key, got)) == sorted(map(key, again))


# --- language model --------------------------------------------------------------------------------------


def test_pitman_base_columns(spark, documents):
    token_lists = {r["doc_id"]: [*words(lower(r["text"])), ""] for r in documents.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in token_lists}
    count = collections.Counter(w for i, t in token_lists.items() if not held[i] for w in t)
    total, distinct = sum(count.values()), len(count)
    got = pitman.op5_pitman(spark, SF_DIR).cache()
    for r in got.collect():
        t = token_lists[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(t), total)
        assert r["n_known"] == sum(count[w] > 0 for w in t) and r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["spelt_score"] <= r["score"] < 0
    by = {r["held_out"]: r for r in pitman.perplexity(got).collect()}
    assert by[True]["perplexity"] < by[True]["base_perplexity"]


def test_seating_follows_its_conditional():
    ways = {(1, 1): 1.0}
    for n in range(1, 20):
        for t in range(1, n + 1):
            ways[n + 1, t] = ways.get((n + 1, t), 0) + ways[n, t] * (n - 0.5 * t)
            ways[n + 1, t + 1] = ways.get((n + 1, t + 1), 0) + ways[n, t]
    rng = np.random.default_rng(0)
    for c, p, other in ((2, 0.1, 3), (5, 0.3, 4), (20, 0.2, 6)):
        weight = np.array([ways[c, t] * math.prod((5 + 0.5 * (other + j)) * p for j in range(t)) for t in range(1, c + 1)])
        drawn = pitman.seat(np.full(8000, c), np.full(8000, p), np.full(8000, other), 5.0, 0.5, rng)
        share = np.bincount(drawn, minlength=c + 1)[1:] / 8000
        assert np.abs(share - weight / weight.sum()).sum() / 2 < 0.04
    many = pitman.seat([5000] * 50, [0.01] * 50, [100] * 50, 5.0, 0.5, rng)
    assert (many >= 1).all() and many.max() < 5000


def test_word_contexts_by_hand(spark, monkeypatch):
    """Scores against the formula over plain counts of words and pairs; the words of every context add up to one."""
    texts = {0: "a b a b c a b", 1: "b a b d a b c", 2: "c c c a b", 4: "", 6: None, 9: "b a a B c", 11: "d e f"}
    asked = {3: "a b zzz b a", 5: "b a zzz b a", 7: "zzz", 8: "e d a b"}
    assert [pitman.held_out(i) for i in (*texts, *asked)] == [False] * len(texts) + [True] * len(asked)
    made, plain = [], pitman.train
    monkeypatch.setattr(pitman, "train", lambda *a: made.append((a, plain(*a))) or made[0][1])
    d = spark.createDataFrame([*texts.items(), *asked.items()], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in pitman.score(d).collect()}
    (all_words, all_pairs, *_), (model, pairs, kept) = made[0]
    tokens = {i: [*words(lower(t or "")), ""] for i, t in (texts | asked).items()}
    follows = {i: list(zip(["", *t[:-1]], t, strict=True)) for i, t in tokens.items()}
    one = collections.Counter(w for i in texts for w in tokens[i])
    two = collections.Counter(x for i in texts for x in follows[i])
    named = {(r["bucket"], r["pos"]): r["word"].decode() for r in all_words.collect()}
    assert sorted(named.values()) == sorted({w for t in tokens.values() for w in t})
    mean = {named[r["home"], r["pos"]]: r for r in model.collect()}
    assert {w: r["c"] for w, r in mean.items() if r["c"]} == one
    by_hash = {xxhash.xxh64_intdigest(w.encode(), 42): w for w in mean}
    known = {r["bucket"]: [by_hash[h] for h in pitman._unpack(r["word"], np.uint64)[0].tolist()] for r in all_pairs.collect()}
    tables = {x: 1.0 for x, n in two.items() if n == 1}
    for r in pairs.collect():
        for u, w, c, t, before in zip(*pitman._unpack(r["data"], *pitman._PAIR), strict=True):
            x = known[r["bucket"]][u], known[r["bucket"]][w]
            tables[x] = float(t + before) / kept
            assert two[x] == c and 1 <= tables[x] <= c
    assert set(tables) == set(two) and max(tables.values()) > 1
    unknown = 1 - sum(r["p"] for r in mean.values() if r["c"])
    theta, part = pitman.PAIR_STRENGTH, pitman.PAIR_DISCOUNT

    def chance(u, w, p):
        served = sum(t for (v, _), t in tables.items() if v == u)
        assert mean[u]["own"] == pytest.approx(served)
        left = two[u, w] - part * tables[u, w] if two[u, w] else 0
        return (left + (theta + part * served) * p) / (theta + one[u])

    for u in mean:
        assert sum(chance(u, w, mean[w]["p"]) for w in one) + chance(u, "zzz", unknown) == pytest.approx(1)
    for i, t in follows.items():
        want = sum(math.log10(chance(u, w, mean[w]["p"] if one[w] else unknown)) for u, w in t)
        assert got[i]["score"] == pytest.approx(want, rel=1e-9)
        want = sum(math.log10(chance(u, w, mean[w]["p"])) for u, w in t)
        assert got[i]["spelt_score"] == pytest.approx(want, rel=1e-9)


def test_word_order_counts(spark):
    rows = [(i, "the cat sat on the mat and the dog sat on the rug") for i in range(0, 40)]
    rows += [(1000, "the cat sat on the mat"), (1001, "mat the on sat cat the")]
    got = {r["doc_id"]: r for r in pitman.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000]["base_score"] == pytest.approx(got[1001]["base_score"])
    assert got[1000]["score"] > got[1001]["score"] + 3


def test_pitman_disk(spark, tmp_path, monkeypatch):
    """No file holds the blocks' pairs, replaced files are gone, and so are the shuffle files of jobs whose table is written."""
    monkeypatch.setattr(pitman, "scratch_path", lambda _, name: f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}-{uuid.uuid4().hex}")
    folders = [str(x) for x in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled() -> dict[str, int]:
        return {str(f): f.stat().st_size for x in folders for f in Path(x).glob("*/shuffle_*.data")}

    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before, text = shuffled(), documents.agg(F.sum(F.octet_length("text"))).collect()[0][0]
    pitman.score(documents)
    left = sum(n for f, n in shuffled().items() if f not in before)
    files = sum(f.stat().st_size for f in tmp_path.glob("*/part-*"))
    assert left < 0.3 * text and files < 2.5 * text


def test_stretches_and_grid():
    block = pitman.Block.__new__(pitman.Block)
    for sizes in ([1], [3, 1, 1, 5, 20, 1], [10] * 7, [100, 1], [1] * 23):
        block.ends = np.cumsum(sizes)
        got = list(block.stretches(10))
        assert [k for x in got for k in range(x.start, x.stop)] == list(range(len(sizes)))
        assert all(sum(sizes[x][:-1]) < 10 for x in got)
    for buckets in (1, 2, 3, 16, 17, 64):
        u, w = np.divmod(np.arange(buckets * buckets), buckets)
        cells = pitman.cell(u, w, buckets).reshape(buckets, buckets)
        assert 0 <= cells.min() and cells.max() < buckets
        most = 2 * math.isqrt(buckets) + 2  # buckets of pairs that one word meets, as context or as word
        assert all(len(set(cells[k]) | set(cells[:, k])) <= most for k in range(buckets))


def test_spelling_is_a_distribution():
    spelling = pitman.Spelling()
    context, symbol, _ = pitman.transitions([b"the", b"then", b"", b"ten", b"the"])
    key, n = np.unique(context * pitman.SYMBOLS + symbol, return_counts=True)
    spelling.gibbs(key // pitman.SYMBOLS, key % pitman.SYMBOLS, n, np.random.default_rng(0), rounds=3)
    assert np.allclose(spelling.p2.sum(axis=1), 1) and np.allclose(spelling.p1.sum(axis=1), 1) and np.isclose(spelling.p0.sum(), 1)
    base = spelling.log_base([b"the", b"zzz", b""])
    assert base[0] > base[1] and np.isfinite(base).all()


# --- quality and the pipeline ------------------------------------------------------------------------------


def plain_quality(text):
    some = words(text)
    n = len(some)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = collections.Counter(tuple(some[i : i + 3]) for i in range(n - 2))
    covered = {j for i in range(n - 2) if windows[tuple(some[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, some)), symbols, len(lines) - len(set(lines)), len(covered)


def signed(h):
    return h - 2**64 if h >> 63 else h


def plain_scores(texts, labels, buckets=quality.BUCKETS):
    """Bucket counts and scores in plain Python."""

    def grams(text):
        h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words(text)]
        pair = [signed(pair_hash(a, b)) for a, b in zip(h, h[1:], strict=False)]
        return [x % buckets for x in h + pair]

    def pair_hash(a, b):  # the hash of a row of two longs: the first one's hash is the seed of the second
        first = xxhash.xxh64_intdigest((a % 2**64).to_bytes(8, "little"), 42)
        return xxhash.xxh64_intdigest((b % 2**64).to_bytes(8, "little"), first)

    raw, trusted = collections.Counter(), collections.Counter()
    for i, t in texts:
        g = grams(t)
        raw.update(g)
        if i in labels:
            trusted.update(g)
    r, t = sum(raw.values()), sum(trusted.values())
    ratio = lambda b: math.log((trusted[b] + 1) / (t + buckets)) - math.log((raw[b] + 1) / (r + buckets))
    return [sum(map(ratio, g)) / len(g) if (g := grams(x)) else 0.0 for _, x in texts]


def test_quality_whole_table(spark, documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    labelled = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()
    score = dict(zip([i for i, _ in texts], plain_scores(texts, {r["doc_id"] for r in labelled}), strict=True))
    want = {i: plain_quality(t) for i, t in texts}
    for r in quality.op3_quality(spark, SF_DIR).collect():
        n, chars, symbols, lines, repeat = want[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
        assert r["score"] == pytest.approx(score[r["doc_id"]], abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)


def test_quality_repeats(spark):
    texts = ["a b c a b c", "a b c d a b c", "a a a a", "a b", "x y z\n" * 4, " a\tb\nc  a b c \n\n"]
    got = quality.judge(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")
    )
    for r in got.collect():
        n, chars, symbols, lines, repeat = plain_quality(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, lines, repeat)


def test_pipeline(spark, documents):
    """The stages one after another in plain Python."""
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    labelled = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").collect()
    score = plain_scores(rows, {r["doc_id"] for r in labelled})
    kept = []
    for (i, t), s in zip(rows, score, strict=True):
        n, *_, repeat = plain_quality(t)
        if n >= 50 and 100 * repeat <= 50 * n and s >= quality.THRESHOLD:
            kept.append((i, t))
    prints = {i: plain_fingerprint(t) for i, t in kept}
    groups = plain_groups(set(prints.values()), 2)
    first = {}
    for i, _ in kept:
        first[groups[prints[i]]] = min(i, first.get(groups[prints[i]], i))
    kept = [(i, t) for i, t in kept if i in set(first.values())]
    find, masked = pii.finder(pii.default_field()), []
    for (i, t), (base, more) in zip(kept, find([t for _, t in kept]), strict=True):
        out, last = "", 0
        for a, kind, b in sorted([*base, *more]):
            if a >= last:
                out += t[last:a] + f"[{kind.upper()}]"
            last = max(last, b)
        masked.append((i, out + t[last:]))
    assert any(a != b for a, b in zip(kept, masked, strict=True)) and len(kept) < len(rows)
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_packing(got.collect(), masked, 4096)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "packing"]
