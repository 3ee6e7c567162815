"""Secrets below byte layers, by exact spans; names and missing ids of dialogues stay apart."""

import base64
import bz2
import gzip
import lzma
import random
import zlib
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stayledger.llm import chat, secrets

PLAIN = b"password=abc123def"


def b64(data):
    return base64.b64encode(data).decode()


def deflate(data):
    tool = zlib.compressobj(9, zlib.DEFLATED, -15)
    return tool.compress(data) + tool.flush()


def found(text):
    spans, oversized = secrets.find(text)
    assert not oversized
    return {text[a:b] for _, a, b, _ in spans}


@pytest.mark.parametrize(
    "hidden",
    [
        b64(gzip.compress(gzip.compress(PLAIN))),
        b64(gzip.compress(bz2.compress(lzma.compress(zlib.compress(PLAIN))))),
        b64(gzip.compress("é à ".encode("latin-1") + PLAIN + b"\xe9")),
        b64(gzip.compress(bytes(range(256)) + PLAIN + b"\xff\x00")),
        b64(deflate(PLAIN * 3)),
        b64(gzip.compress(b64(gzip.compress(PLAIN)).encode())),
    ],
)
def test_base64_of_packed_bytes(hidden):
    assert hidden in found(f"see {hidden} there")


def test_escaped_bytes():
    packed = gzip.compress(PLAIN)
    assert found(f"see {quote(packed)} there") == {quote(packed)}
    escaped = repr(packed)[2:-1]
    assert found(f"é see '{escaped}' there") == {escaped}
    assert found("see " + "".join(f"\\u00{x:02x}" for x in packed) + " there") == {
        "".join(f"\\u00{x:02x}" for x in packed)
    }
    assert "%70assword=abc123def" in found("see %FF%70assword=abc123def there")


@pytest.mark.parametrize("coding", ["utf-16", "utf-16-le", "utf-16-be"])
def test_letters_of_two_bytes(coding):
    hidden = b64("é password=abc123def é".encode(coding))
    parts = found(f"see {hidden} there")
    assert parts and all(p in hidden for p in parts)


def test_a_packed_block_behind_a_window_is_counted(monkeypatch):
    noise = random.Random(5).randbytes(40_000)
    inner = gzip.compress(noise)
    text = b64(gzip.compress(inner + PLAIN))
    assert secrets.find(text)[1] == 0
    monkeypatch.setattr(secrets, "MAX_UNPACKED", 1 << 14)
    monkeypatch.setattr(secrets, "OVERLAP", 1 << 10)
    spans, oversized = secrets.find(text)
    assert oversized and spans  # the block is counted, the secret behind it is still found


LAYERS = [
    lambda x: b64(x).encode(),
    lambda x: quote(x, safe="").encode(),
    lambda x: b64(gzip.compress(x, mtime=0)).encode(),
    lambda x: b64(bz2.compress(x)).encode(),
    lambda x: quote(zlib.compress(x)).encode(),
    lambda x: b64(gzip.compress(zlib.compress(x), mtime=0)).encode(),
    lambda x: b"".join(b"\\x%02x" % c for c in x),
]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(LAYERS), min_size=1, max_size=4), st.sampled_from(["", "å ", "n: "]))
def test_any_nesting_maps_into_the_text(layers, before):
    hidden = PLAIN
    for wrap in layers:
        hidden = wrap(hidden)
    text = f"{before}<{hidden.decode()}>"
    spans, oversized = secrets.find(text)
    start = len(before) + 1
    inside = [(a, b) for kind, a, b, _ in spans if kind == "assign" and start <= a < b <= len(text) - 1]
    assert inside and not oversized


def test_dialogues_without_id_and_like_names_stay_apart(spark):
    rows = [
        (None, 0, "ann", "lost"), ("null", 0, "bob", "kept"), ("id null", 0, "eve", "third"),
        ("names", 0, "a b", "1"), ("names", 1, "a_b", "2"), ("names", 2, "a%20b", "3"), ("names", 3, "<b>", "4"),
    ]
    table = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {(r.conversation, r.perspective): r.text for r in chat.rendered(chat.segments(table)).collect()}
    assert {k for k in got if k[0] != "names"} == {(None, "ann"), ("null", "bob"), ("id null", "eve")}
    assert got[(None, "ann")].count(chat.OPEN) == 1
    named = got[("names", "<b>")]
    assert all(f"user name={n}\n" in named for n in ("a%20b", "a_b", "a%2520b"))
