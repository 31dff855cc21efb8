"""Layers that hold unprintable characters, escapes inside a line, wrapped base64 and several streams."""

import base64
import gzip
import os
import random
import zlib

import pytest

from ledgerlark.llm import secrets

PLAIN = 'password = "hunter2hunter2"'


def wrapped(raw):
    return base64.encodebytes(raw).decode()


def noise(n):
    r = random.Random(n)
    return " ".join(r.choice("abcdefgh") + str(r.random()) for _ in range(n))


@pytest.mark.parametrize("odd", ["\xa0", "\u3000", "\ufeff", "\u200b", "\f", "\x00", b"\xff"])
def test_unprintable_layers(odd):
    raw = (odd if isinstance(odd, bytes) else odd.encode()) + PLAIN.encode()
    for body in (raw, zlib.compress(raw)):
        text = f"go {base64.b64encode(body).decode()} end"
        assert {k for _, k, _ in secrets.decoded_spans(text)[0]} == {"assign"}


def test_escapes_keep_their_line():
    text = '"password": "\\u0068unter2hunter2"'
    assert secrets.decoded_spans(text)[0] == {(1, "assign", len(text) - 1)}
    text = "password = %68unter2hunter2"
    assert not secrets.base_spans(text) and secrets.decoded_spans(text)[0] == {(0, "assign", len(text))}


@pytest.mark.parametrize("words", [0, 5, 6, 7, 40])
def test_wrapped_base64(words):
    for raw in (zlib.compress(f"{noise(words)} {PLAIN} {noise(words)}".encode()), f"{noise(words)} {PLAIN}".encode()):
        for text in (f"go\n{wrapped(raw)}end", wrapped(raw).replace("\n", "\r\n  ")):
            found, _ = secrets.decoded_spans(text)
            assert {k for _, k, _ in found} == {"assign"}
            assert all(0 <= a < b <= len(text) for a, _, b in found)


def test_streams_in_a_row():
    for raw in (gzip.compress(b"x") + gzip.compress(PLAIN.encode()), gzip.compress(b"x ") + PLAIN.encode()):
        assert secrets.decoded_spans(base64.b64encode(raw).decode())[0]
    cut = zlib.compress(PLAIN.encode() + b" " + base64.b64encode(os.urandom(3000)))[:-20]
    assert secrets.decoded_spans(base64.b64encode(cut).decode())[0]
