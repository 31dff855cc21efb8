"""Personal data: rules, and a linear-chain conditional random field over word shapes.

The rules find e-mail addresses, IPv4 addresses, card and phone numbers as written. The field adds
spans in forms the rules do not know. It is trained by gradient ascent on a small labelled table
(``LABELLED`` by default) and decodes blank-separated words: the score of a tag is the sum of weights
of the word's own shape and of the two neighbours on either side, plus the weight of the step from one tag to the next.

Decoding is exact Viterbi in numpy batches. Only words that are not plain (letters with ordinary
punctuation) differ in score from their surroundings, so the chain is cut where a run of plain words
is so long that every best path passes through the tag O inside it; ``Field.gap`` finds that length from the
trained weights. The windows that remain are decoded together, all windows of one length at a time.

NULL and empty texts give no spans. Rows are handled one by one, so repeated rows give repeated
results; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerlark.llm.common import id_and_text, per_batch, read, sha256, span_text, with_column
from ledgerlark.llm.registry import query

KINDS = {"email": 0, "ip": 1, "card": 2, "phone": 3}
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# The labelled table; [kind words] marks a span, all else is outside.
LABELLED = (
    "write to [email anna dot berg at example dot com] before noon",
    "you can reach me under [email j.smith (at) mail.example.org] any day",
    "mail [email maria at posteo dot de] or call the office at two",
    "contact [email info [at] firma [dot] com] for the full report",
    "my address is [email peter_m (at) example (dot) net] thanks",
    "e-mail: [email lena.k [at] uni-bonn.de] if you need the data",
    "send it to [email tom at mail dot example dot com] please",
    "phone [phone (743) 555-3824] is the number of the desk",
    "call [phone (212) 555-0147] between nine and five",
    "call me at [phone 415-555-0199] after the meeting",
    "tel. [phone 555-123-4567] or write a letter",
    "fax [phone (020) 7946-0958] and wait",
    "her number is [phone 415-555-0132] as of today",
    "mobile: [phone 0171-555-2368] only in the evening",
    "phone: [phone (03) 9555-1234] on weekdays",
    "the host [ip 10 . 0 . 0 . 12] answers no ping",
    "server [ip 192 . 168 . 1 . 20] was down",
    "card number [card 4111.1111.1111.1111] expires soon",
    "paid by card [card 5500.0000.0000.0004] in march",
    "pages 120 to 135 of volume 12 were lost at sea",
    "in 2019 the value rose from 1200 to 3400 at last",
    "the meeting is at 10:30 on 12-05-2021 in room 404",
    "see section 3.2.1 and table 4 at the end",
    "he is at home and she is at work",
    "the price is 1,200.50 at most and 900 at least",
    "version 2.0 was released on 2020-01-15 to all",
    "look at the dot at the end of the line",
    "order 12345678 shipped in 3 boxes of 24",
    "a ratio of 3 to 5 or (see note 7) more",
    "the sum (1200) and the rest (800) match",
    "scores were 21-19 and 21-15 in two sets",
    "he ran 100 m in 10.5 s at the age of 19",
    "chapter 7 - the end . and so on",
    "it cost $ 25 & more *** at that time",
    "the #1 item <b> in list 5 | end",
    "from 9-17 on monday to friday at the shop",
    "isbn 978-3-16-148410-0 at the library",
    "call the function at line 120 of the file",
    "phone the doctor or write to the office",
    "the card was lost and the server was down",
    "name | size | colour | place | owner | year | kind | state",
    "this !! is !! what !! they !! wrote !! on !! the !! wall",
    "and### the&&& lines*** of%%% noise$$$ went### on&&& and*** on",
    "ask [email tim at example dot net] because they know how the long story of the river and the old town came to its end last year",
    "so [email eva at posteo dot de] wrote a few lines about the sea the wind the boats and the people of the small harbour",
    "if you wish please write to [email hans dot kohl at example dot org] for more of them",
    "do write to [email o.berg at mail dot net] for your copy",
    "under [email k.lund (at) example.org] there was never an answer to any of the many letters that we had sent them over the years",
    "in the morning the light came over the hills and the whole valley lay still while nobody spoke a single word",
    "nothing in this long line of plain words names a person or a number and it should stay as it is from start to end",
)

TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
_CUES = frozenset("at dot phone call tel tel. fax mobile mobile: phone: number e-mail: mail write to card server host".split())
_PLAIN = re.compile(r"[(\"'¿¡]*[^\W\d_]+(?:['’-][^\W\d_]+)*[.,;:!?)\"']*")
_MARK = re.compile(r"\[(email|ip|card|phone) (.*?)\](?= |$)")
_WORD = re.compile(r"\S+")
PLAIN = "x"


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def rule_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the rules, leftmost and not overlapping within a kind."""
    spans, last, at = [], 0, text.find("@")
    while at >= 0:  # an address starts where the run of local characters before its @ starts
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            spans.append((start, "email", m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    spans += [(m.start(), "ip", m.end()) for m in _IP.finditer(text) if all(int(g[-20:]) < 256 and len(g.lstrip("0")) < 4 for g in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((m.start(), "phone", m.end()))
    return spans


def shape(word: str) -> str:
    """Plain words are one shape, cue words stand for themselves, others keep digits, case and signs."""
    low = word.lower()
    if low in _CUES:
        return "=" + low
    if _PLAIN.fullmatch(word):
        return PLAIN
    out, last, run = [], "", 0
    for c in word:
        k = "d" if c.isdigit() else "a" if c.isalpha() else c
        run = run + 1 if k == last else 1
        if k != last or (k == "d" and run <= 4):
            out.append(k)
        last = k
        if len(out) > 24:
            break
    return "".join(out)


def labelled_rows(lines: Sequence[str] = LABELLED) -> list[tuple[list[str], list[str]]]:
    """(words, tags) of marked lines."""
    rows = []
    for line in lines:
        words, tags, pos = [], [], 0
        for m in [*_MARK.finditer(line), None]:
            plain = line[pos : m.start() if m else len(line)].split()
            words, tags = words + plain, tags + ["O"] * len(plain)
            if m:
                inside = m[2].split()
                words += inside
                tags += [f"B-{m[1]}"] + [f"I-{m[1]}"] * (len(inside) - 1)
                pos = m.end()
        rows.append((words, tags))
    return rows


class Field:
    """Weights of tag steps and of (place, shape) features; places are -2 to 2."""

    PLACES = (-2, -1, 0, 1, 2)

    def __init__(self, rows, rounds: int = 200, rate: float = 0.2, penalty: float = 0.01):
        shapes = sorted({shape(w) for words, _ in rows for w in words} | {PLAIN, "", "?"})
        self.ids = {s: i for i, s in enumerate(shapes)}
        self.edge, self.other = self.ids[""], self.ids["?"]  # beyond the line; a shape never seen
        k, tag = len(TAGS), {t: i for i, t in enumerate(TAGS)}
        self.steps = np.zeros((k, k))
        for i, t in enumerate(TAGS):  # an inner tag follows its own kind only
            if t[0] == "I":
                self.steps[[j for j, u in enumerate(TAGS) if u[1:] != t[1:]], i] = -1e4
        self.first = np.array([-1e4 if t[0] == "I" else 0.0 for t in TAGS])
        self.emit = np.zeros((len(self.PLACES), len(shapes), k))
        data = [(self._codes(words), np.array([tag[t] for t in tags])) for words, tags in rows]
        allowed = self.steps > -1e3
        for r in range(rounds):  # full-batch gradient ascent on the penalised log-likelihood
            g_emit, g_steps = -penalty * self.emit, np.where(allowed, -penalty * self.steps, 0)
            for codes, tags in data:
                score = self.scores(codes)
                p_tag, p_step = self._marginals(score)
                error = -p_tag
                error[np.arange(len(tags)), tags] += 1
                for j in range(len(self.PLACES)):
                    np.add.at(g_emit[j], codes[:, j], error)
                g_steps -= np.where(allowed, p_step, 0)
                np.add.at(g_steps, (tags[:-1], tags[1:]), 1)
            step = rate / (1 + r / 100)
            self.emit += step * g_emit
            self.steps += step * g_steps
        self.emit[:, self.other, 1:] = -4.0  # a shape never seen is no evidence for a span
        self.gap = self._gap()

    def codes(self, words: Sequence[str]) -> np.ndarray:
        return np.array([self.ids.get(shape(w), self.other) for w in words], np.int64)

    def _codes(self, words: Sequence[str]) -> np.ndarray:
        return self.around(self.codes(words), 0, len(words))

    def around(self, codes: np.ndarray, start: int, end: int) -> np.ndarray:
        """Shape ids at all places around each of the words from ``start`` to ``end``."""
        at = np.arange(start, end)[:, None] + np.array(self.PLACES)
        return np.where((at >= 0) & (at < len(codes)), codes[at.clip(0, len(codes) - 1)], self.edge)

    def scores(self, around: np.ndarray) -> np.ndarray:
        return sum(self.emit[j][around[..., j]] for j in range(len(self.PLACES)))

    def _marginals(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(score)
        fwd, bwd = np.empty_like(score), np.zeros_like(score)
        fwd[0] = self.first + score[0]
        for t in range(1, n):
            fwd[t] = score[t] + np.logaddexp.reduce(fwd[t - 1][:, None] + self.steps, axis=0)
        for t in range(n - 2, -1, -1):
            bwd[t] = np.logaddexp.reduce(self.steps + score[t + 1] + bwd[t + 1], axis=1)
        z = np.logaddexp.reduce(fwd[-1])
        p_step = np.zeros_like(self.steps)
        for t in range(n - 1):
            p_step += np.exp(fwd[t][:, None] + self.steps + score[t + 1] + bwd[t + 1] - z)
        return np.exp(fwd + bwd - z), p_step

    def _gap(self, most: int = 64) -> int:
        """h such that among plain words, h steps from the last other word and h before the next one,
        every best path is in O, and stays in O between two such places.

        F_k holds the best weight of k steps from tag to tag under constant scores. If
        F_h[a, O] + F_h[O, b] >= F_2h[a, b] for all a and b, then O is best h steps from either end, in
        longer runs too. No closed walk may beat staying in O; simple ones suffice to see that.
        """
        x = self.ids[PLAIN]
        step = self.steps + sum(self.emit[j][x] for j in range(len(self.PLACES)))[None, :]
        step = step - step[0, 0]
        power = [None, step]
        for _ in range(2 * most):
            power.append((power[-1][:, :, None] + step[None]).max(axis=1))
        if max(np.diag(p).max() for p in power[1 : len(TAGS) + 1]) <= 1e-9:
            for h in range(1, most):
                reach = power[2 * h]
                if (power[h][:, :1] + power[h][:1, :] >= reach - 1e-9)[reach > -5e3].all():
                    return h
        raise ValueError("plain words do not lead back to O; train on more lines of plain words")

    def windows(self, flat: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray):
        """First and last places to decode: other words and the ends of texts, with a margin.

        ``flat`` holds the shape ids of many texts with edges between them, ``doc`` the number of the
        text at each place (-1: edge), ``first`` and ``last`` the places of its ends.
        """
        margin = self.gap + 2
        mark = (flat != self.ids[PLAIN]) & (doc >= 0)
        mark[first], mark[last] = True, True
        at = np.flatnonzero(mark)
        cut = np.flatnonzero((np.diff(at) > 2 * margin + 1) | (np.diff(doc[at]) > 0))
        lo = at[np.concatenate([[0], cut + 1])]
        hi = at[np.concatenate([cut, [len(at) - 1]])]
        return np.maximum(lo - margin, first[doc[lo]]), np.minimum(hi + margin, last[doc[hi]])

    def best_tags(self, flat, lo, hi, open_start, open_end) -> list[np.ndarray]:
        """Viterbi over windows [lo, hi] of any lengths, longest first, all windows at once.

        A window that begins or ends inside a text has the tag O there.
        """
        inside = np.where(np.arange(len(TAGS)) == 0, 0.0, -1e5)
        length = hi - lo + 1
        steps, places = self.steps.T.copy(), np.array(self.PLACES)
        # Scores of all places, those of the first words first.
        live = np.searchsorted(-length, -np.arange(length[0]), side="left")
        at = np.cumsum([0, *live])
        place = np.arange(at[-1]) - np.repeat(at[:-1], live)
        scores = self.scores(flat[(lo[place] + np.repeat(np.arange(length[0]), live))[:, None] + places])
        backs, best = [], scores[: live[0]] + np.where(open_start[:, None], self.first, inside)
        for t, n in enumerate(live[1:].tolist(), start=1):
            reach = best[:n, None, :] + steps
            backs.append(reach.argmax(axis=2).astype(np.int8))
            best[:n] = reach.max(axis=2) + scores[at[t] : at[t + 1]]
        tag = (best + np.where(open_end[:, None], 0.0, inside)).argmax(axis=1)
        out = []
        for back in reversed(backs):  # windows shorter than this place keep their last tag
            live = len(back)
            out.append(tag[:live].astype(np.int8))
            tag[:live] = back[np.arange(live), tag[:live]]
        out.append(tag.astype(np.int8))
        return out[::-1]

    def tagged(self, many: list[np.ndarray]) -> list[list[tuple[int, int, str]]]:
        """(first word, end word, kind) of the spans in each of many texts, given as shape ids."""
        found: list[list[tuple[int, int, str]]] = [[] for _ in many]
        full = [d for d, codes in enumerate(many) if len(codes)]
        if not full:
            return found
        edge = np.full(2, self.edge, np.int32)
        flat = np.concatenate([x for d in full for x in (edge, many[d])] + [edge])
        size = np.array([len(many[d]) for d in full])
        first = np.cumsum(size + 2) - size
        last = first + size - 1
        doc = np.full(len(flat), -1)
        doc[np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])] = np.repeat(np.arange(len(full)), size)
        lo, hi = self.windows(flat, doc, first, last)
        order = np.argsort(lo - hi, kind="stable")
        lo, hi = lo[order], hi[order]
        tags = np.zeros(len(flat), np.int8)
        for t, row in enumerate(self.best_tags(flat, lo, hi, lo == first[doc[lo]], hi == last[doc[hi]])):
            tags[lo[: len(row)] + t] = row
        for at in np.flatnonzero(tags % 2).tolist():  # B-kind, followed by I-kind
            end = at + 1
            while end < len(tags) and tags[end] == tags[at] + 1:
                end += 1
            d = doc[at]
            found[full[d]].append((at - int(first[d]), end - int(first[d]), TAGS[tags[at]][2:]))
        return found


@cache
def default_field() -> Field:
    return Field(labelled_rows())


def _valid(kind: str, text: str) -> bool:
    """The check that a decoded span must pass."""
    digits = re.findall(r"[0-9]+", text)
    if kind == "email":
        return bool(_SPELT.fullmatch(text))
    if kind == "ip":
        return len(digits) == 4 and all(len(d) <= 3 and int(d) <= 255 for d in digits)
    joined = "".join(digits)
    if kind == "card":
        return 14 <= len(joined) <= 19 and luhn(joined)
    return 10 <= len(joined) <= 15


_SPELT = re.compile(
    r"[\w.%+-]+(?: dot [\w%+-]+)*\s*(?:@|\(at\)|\[at\]|\bat\b)\s*[\w-]+(?:\s*(?:\.|\(dot\)|\[dot\]|\bdot\b)\s*[\w-]+)+", re.IGNORECASE
)
_ENDS, _STARTS = ".,;:!?\"'", "\"'"


#: Words whose shapes a task remembers; the memory is emptied when it is full and ends with the task.
REMEMBERED = 500_000


def finder(field: Field):
    """A function from texts to (rule spans, added spans) of each."""
    known: dict[str, int] = {}

    def many(texts: list[str]) -> list[tuple[list, list]]:
        if len(known) > REMEMBERED:
            known.clear()
        coded = []
        for text in texts:
            words = text.split()
            try:
                codes = [known[w] for w in words]
            except KeyError:
                known.update((w, field.ids.get(shape(w), field.other)) for w in {*words} if w not in known)
                codes = [known[w] for w in words]
            coded.append(np.array(codes, np.int32))
        out = []
        for text, spans in zip(texts, field.tagged(coded), strict=True):
            base, more = rule_spans(text), []
            if spans:
                places = [m.span() for m in _WORD.finditer(text)]
                for a, b, kind in spans:
                    start, end = places[a][0], places[b - 1][1]
                    while end > start and text[end - 1] in _ENDS:
                        end -= 1
                    while start < end and text[start] in _STARTS:
                        start += 1
                    if _valid(kind, text[start:end]) and not any(s < end and start < e for s, _, e in base):
                        more.append((start, kind, end))
            out.append((base, more))
        return out

    return many


def field_from(labelled: DataFrame | None, limit: int = 10_000) -> Field:
    """The field trained on the marked lines of a table with a column ``line``: the first ``limit`` in
    the order of their hash. Without a table, the field of the built-in lines."""
    if labelled is None:
        return default_field()
    lines = labelled.select("line").where(F.col("line").isNotNull()).distinct()
    lines = lines.orderBy(F.xxhash64("line"), "line").limit(limit).collect()
    return Field(labelled_rows([r["line"] for r in lines]))


def detect(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts and digest of the rule spans, and all spans as text."""
    field = field_from(labelled)

    def make():
        find = finder(field)

        def many(texts):
            rows = []
            for base, more in find(texts):
                count = [sum(k == kind for _, k, _ in base) for kind in KINDS]
                rows.append((*count, sha256(span_text(base, KINDS)), span_text([*base, *more], KINDS)))
            return rows

        return many

    return per_batch(
        id_and_text(docs, id_col, text_col), make,
        "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span replaced by its kind in brackets; NULL texts stay NULL.

    ``n_chars``, where the table has it, becomes the new length.
    """
    field = field_from(labelled)

    def make():
        find = finder(field)

        def masked(texts: list[str]) -> list[str]:
            out = []
            for text, (base, more) in zip(texts, find(texts), strict=True):
                parts, last = [], 0
                for start, kind, end in sorted([*base, *more]):
                    if start >= last:
                        parts += [text[last:start], f"[{kind.upper()}]"]
                    last = max(last, end)
                out.append("".join([*parts, text[last:]]))
            return out

        return masked

    # Numbered column names, so that none of the table's can clash with the one added here.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = dict(zip(docs.columns, plain.columns, strict=True))
    text = F.col(names[text_col])
    out = with_column(plain.withColumn(names[text_col], text.cast("string")), names[text_col], "masked", "string", make)
    changed = {names[text_col]: F.when(text.isNotNull(), F.col("masked"))}
    if "n_chars" in docs.columns:
        changed[names["n_chars"]] = F.length(F.when(text.isNotNull(), F.col("masked"))).cast("long")
    return out.withColumns(changed).select(*plain.columns).toDF(*docs.columns)


@query()
def op7_pii(spark, sf_dir):
    return detect(read(spark, sf_dir, "documents"))
