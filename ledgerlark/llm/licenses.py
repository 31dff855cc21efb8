"""License scan: phrases in place, and an exact set-similarity join of text blocks with templates.

A block is one line of a text. Blocks and templates are sets of words; a block matches a template
if it holds at least ``threshold`` of the template's distinct words. With o = ceil(threshold * |T|)
words needed, the join keeps three filters that lose no match:

* prefix: with the words of all templates ordered from rare to frequent in the whole corpus, the
  first |T| - o + 1 words of the template and the first |B| - o + 1 of the block share a word
  (words that stand in no template cannot add to any overlap and are left out of B);
* length: |B| >= o;
* position: a shared word at places i and j leaves room for o, 1 + min(|T| - 1 - i, |B| - 1 - j) >= o.

NULL and empty texts hold no word: counts 0, no labels, score 0. Rows are handled one by one, so
repeated rows give repeated results; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import id_and_text, per_text, read, tidied
from ledgerlark.llm.registry import query

# Phrases and their labels, and notices by which licenses are usually named.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software you can redistribute it and/or modify it under the terms of the GNU"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.8

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 10 if c == 10 else 32
    for c in range(256)
)


def words_of_lines(text: str) -> list[list[bytes]]:
    """The words of each line as UTF-8: runs of digits, letters and code points from U+0080, A-Z lowered."""
    return [line.split() for line in text.encode("utf-8", "replace").translate(_WORD_BYTES).split(b"\n")]


def template_sets(templates: Sequence[tuple[str, str]]) -> list[tuple[str, frozenset[bytes]]]:
    return [(label, frozenset(w for line in words_of_lines(t) for w in line)) for label, t in templates]


def word_frequency(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """In how many texts each of the given words stands; as many rows as words reach the driver."""

    def run(batches):
        count = dict.fromkeys(words, 0)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                flat = (text or "").encode("utf-8", "replace").translate(_WORD_BYTES)
                for w in words.intersection(flat.split()):
                    count[w] += 1
        found = [(w.decode(), n) for w, n in count.items() if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
            names=["word", "n"],
        )

    rows = docs.select("text").mapInArrow(tidied(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in rows.collect()}


class TemplateIndex:
    """Prefix index over the templates, in the global order of their words."""

    def __init__(self, templates, frequency: Mapping[bytes, int], threshold: float):
        sets = template_sets(templates)
        order = sorted({w for _, s in sets for w in s}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.labels = [label for label, _ in sets]
        self.ordered = [sorted(self.rank[w] for w in s) for _, s in sets]
        self.members = [frozenset(o) for o in self.ordered]
        self.need = [max(1, math.ceil(threshold * len(o) - 1e-9)) for o in self.ordered]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, o in enumerate(self.ordered):
            for i, r in enumerate(o[: len(o) - self.need[t] + 1]):
                self.prefix.setdefault(r, []).append((t, i))
        words = {r: w for w, r in self.rank.items()}
        self.first = frozenset(words[r] for r in self.prefix)

    def matches(self, line: list[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that the line meets."""
        if self.first.isdisjoint(line):
            return []
        block = sorted({self.rank[w] for w in line if w in self.rank})
        size, seen, found = len(block), set(), []
        for j, r in enumerate(block):
            for t, i in self.prefix.get(r, ()):
                need, total = self.need[t], len(self.ordered[t])
                if t in seen or size < need or j > size - need or 1 + min(total - 1 - i, size - 1 - j) < need:
                    continue
                seen.add(t)
                shared = len(self.members[t].intersection(block))
                if shared >= need:
                    found.append((t, shared / total))
        return found


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: number of words, places of the phrases, labels of phrases and templates, best containment."""
    texts = id_and_text(docs, id_col, text_col)
    vocabulary = frozenset().union(*(s for _, s in template_sets(templates)))
    frequency = word_frequency(texts, vocabulary)
    wanted = [(tuple(w.encode() for w in p.split()), label) for p, label in phrases.items()]

    def make():
        index = TemplateIndex(templates, frequency, threshold)
        last_words = {p[-1]: [] for p, _ in wanted}
        for p, label in wanted:
            last_words[p[-1]].append((p, label))
        endings = frozenset(last_words)

        def one(text: str):
            n, starts, base, more, score = 0, [], set(), set(), 0.0
            before: list[bytes] = []  # the words just before the line, for phrases that cross lines
            keep = max((len(p) for p, _ in wanted), default=1) - 1
            for line in words_of_lines(text):
                if not line:
                    continue
                if not endings.isdisjoint(line):
                    run = before + line
                    for at in range(len(before), len(run)):
                        for p, label in last_words.get(run[at], ()):
                            if at + 1 >= len(p) and tuple(run[at + 1 - len(p) : at + 1]) == p:
                                starts.append(n - len(before) + at + 1 - len(p))
                                base.add(label)
                for t, share in index.matches(line):
                    more.add(index.labels[t])
                    score = max(score, share)
                n += len(line)
                before = (before + line)[-keep:] if keep else []
            return (
                n, len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | more)), score,
            )

        return one

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = ["long", "long", "long", "long", "string", "string", "double"]
    return per_text(texts, make, ", ".join(f"{a} {b}" for a, b in zip(names, kinds, strict=True)))


def _oracle() -> str:
    """Brute force in SQL: every line against every template, no filter."""
    sets = template_sets(TEMPLATES)
    rows = ", ".join(
        f"({k}, '{label}', [{', '.join(repr(w.decode()) for w in sorted(s))}], {max(1, math.ceil(THRESHOLD * len(s) - 1e-9))})"
        for k, (label, s) in enumerate(sets)
    )
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    phrase = ", ".join(
        f"({len(p.split())}, '{label}', [{', '.join(repr(w) for w in p.split())}])" for p, label in PHRASES.items()
    )
    return f"""
WITH t(k, label, words, need) AS (VALUES {rows}),
p(size, label, words) AS (VALUES {phrase}),
d AS (
  SELECT doc_id, row_number() OVER () AS r,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (SELECT doc_id, r, text, regexp_extract_all(text, '{word}') AS words FROM d),
lines AS (SELECT r, regexp_extract_all(unnest(string_split(text, chr(10))), '{word}') AS words FROM w),
hits AS (
  SELECT r, label, len(list_intersect(t.words, lines.words)) / len(t.words)::DOUBLE AS share
  FROM lines, t WHERE len(list_intersect(t.words, lines.words)) >= need),
best AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS score FROM hits GROUP BY r),
places AS (
  SELECT r, p.label, unnest(list_filter(range(len(w.words)), lambda i:
    list_slice(w.words, i + 1, i + p.size) = p.words)) AS i
  FROM w, p),
base AS (
  SELECT r, count(*) AS n, min(i) AS a, max(i) AS b, list(DISTINCT label) AS labels FROM places GROUP BY r)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base,
  base.a::BIGINT AS first_word, base.b::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(
    list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ','), '') AS labels,
  coalesce(best.score, 0)::DOUBLE AS score
FROM w LEFT JOIN base USING (r) LEFT JOIN best USING (r)"""


@query(_oracle())
def op2_licenses(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))
