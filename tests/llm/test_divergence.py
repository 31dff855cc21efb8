"""The source audit against brute force: perfect hashes, rounds, groups without terms, NULLs."""

import collections
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest

from ledgerlark.llm import divergence

sys.path.insert(0, str(Path(__file__).parent))
from cases import lower  # noqa: E402

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, min_docs, top):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    texts, count, whole = collections.Counter(), collections.Counter(), collections.Counter()
    for t, a, _ in rows:
        texts.update((a, w) for w in set(TERM.findall(lower(t))))
    kept = collections.defaultdict(set)
    for (a, w), n in texts.items():
        if n >= min_docs:
            kept[a].add(w)
    groups = {(a, s) for _, a, s in rows}
    for t, a, s in rows:
        for w in TERM.findall(lower(t)):
            if w in kept[a]:
                count[a, s, w] += 1
                whole[a, w] += 1

    def share(c, a, total):
        return 1 + 10**9 * (c + 5) // (total + 5 * len(kept[a]))

    total = {g: sum(count[*g, w] for w in kept[g[0]]) for g in groups}
    out = []
    for a, s in groups:
        value = {}
        for b, z in groups:
            if a == b and z != s:
                value[z] = sum(abs(share(count[a, s, w], a, total[a, s]) - share(count[a, z, w], a, total[a, z])) for w in kept[a])
        for k, (z, f) in enumerate(sorted(value.items(), key=lambda x: (-x[1], x[0].encode()))):
            out.append((a, s, "pair", z, f, k + 1))
        all_n = sum(whole[a, w] for w in kept[a])
        more = {}
        for w in kept[a]:
            p, q = (share(count[a, s, w], a, total[a, s]), share(whole[a, w], a, all_n))
            if count[a, s, w] and p > q:
                more[w] = p - q
        for k, (w, f) in enumerate(sorted(more.items(), key=lambda x: (-x[1], x[0].encode()))[:top]):
            out.append((a, s, "term", w, f, k + 1))
    return sorted(out)


def got(spark, rows, **how):
    df = spark.createDataFrame(rows, "text string, lang string, source string, cell long, p string, block string")
    return sorted(map(tuple, divergence.audit(df, **how).collect()))


@pytest.mark.parametrize(("per_shard", "per_round"), [(4096, 2_000_000), (9, 25)])
def test_audit(spark, per_shard, per_round):
    r = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Ärger", "ärger", "中文", "A1b", "x"]
    rows = []
    for i in range(160):
        text = " ".join(r.choice(words[: 20 + 15 * (i % 5)]) for _ in range(r.randrange(40)))
        rows.append((r.choice([text, text.upper(), text + "\n"]), r.choice(["en", "de", None]), f"s{i % 5}", 1, "x", "y"))
    rows += [(None, "en", None, 1, "x", "y"), ("", "en", "empty", 1, "x", "y"), ("one two", "fr", "s1", 1, None, None)]
    rows += [("3 4 5", "fr", "s2", None, None, None), ("word " * 30_000, "de", "s1", 0, "", "")]
    rows += rows[:7]
    plain = plain_audit([x[:3] for x in rows], 4, 6)
    assert got(spark, rows, min_docs=4, top=6, per_shard=per_shard, per_round=per_round) == plain
    assert {x[2] for x in plain} == {"pair", "term"} and any(x[4] == 0 for x in plain)


def test_audit_empty(spark):
    assert got(spark, []) == []


def test_perfect_hash():
    keys = [f"key{i}".encode() for i in range(5000)]
    parts = []
    for shard in range(3):
        mine = [k for k in keys if int(divergence.hashes([k], 42).view(np.int64)[0]) % 3 == shard]
        seed, levels, order = divergence.build(mine)
        assert sorted(order.tolist()) == list(range(len(mine))) and sum(x.sum() for x in levels) == len(mine)
        bits = np.packbits(np.concatenate(levels)).tobytes()
        parts.append({"shard": shard, "seed": seed, "sizes": [len(x) for x in levels], "bits": bits, "keys": [mine[i] for i in order]})
    table = divergence.Perfect.of(parts, 3)
    slot = table.slots(keys + [b"other", b"", b"key5000"])
    assert sorted(slot[:5000].tolist()) == list(range(5000)) and (slot[5000:] == -1).all()
    some = divergence.Perfect.of(parts[1:2], 3)
    slot = some.slots(keys)
    assert sorted(slot[slot >= 0].tolist()) == list(range(len(parts[1]["keys"])))
