"""Rows that every text operator must survive, and brute-force helpers."""

import random
import re

WORDS = "the of and in on was that with harbour river stone lamp paper window garden street winter silver".split()
COLUMNS = (
    "doc_id long, text string, kept string, score string, labels string, spans string, fp string, length string, "
    "start string, task string, rank string, n_words string, word string, `block` string, `_row` string, `_hash` string"
)


def prose(n, seed=0):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (".\n" if r.random() < 0.05 else "") for _ in range(n))


def odd_rows():
    """NULL ids and texts, empty and blank texts, a very long word, a long text, copies and repeated rows."""
    texts = [
        (None, prose(60, 1)), (1, None), (2, ""), (3, " \n\t "), (4, "x" * 60_000), (5, prose(6000, 2)),
        (6, prose(80, 3)), (7, prose(80, 3)), (6, prose(80, 3)), (8, "é ́x ☃①\x00b ▁y"), (9, "one"),
        (None, None), (10, "a b"), (11, "A B"), (12, "%%%% \\\\u00 +++ @@@ 1.2.3.4.5 |||"),
    ]
    return [(i, t, *["clash"] * 14) for i, t in texts]


def frame(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, columns)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
