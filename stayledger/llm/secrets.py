"""Secret scans: every text layer is scanned, then unwrapped, until nothing new appears."""

from __future__ import annotations

import base64
import bisect
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, free_names, joined_digest, text_of, without

KINDS = ("assign", "access", "hex")
# Letters are spelled in both cases, so that no other alphabet's letters match.
_WORDS = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w).replace("_", "_?")
    for w in ("password", "passwd", "secret", "token", "api_key")
)
ASSIGN = re.compile(rf"(?:{_WORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
ESCAPED = re.compile(r"\\[uUx]([0-9A-Fa-f]+)")
# Escapes that stand for one byte, and those among them that no plain text needs.
BYTE_ESCAPE = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([nrtabfv'\"\\]))")
HIGH_ESCAPE = re.compile(r"\\(?:x|u00)[89A-Fa-f][0-9A-Fa-f]")
SHORT_ESCAPES = dict(zip("nrtabfv'\"\\", (b"\n", b"\r", b"\t", b"\a", b"\b", b"\f", b"\v", b"'", b'"', b"\\")))
BASE64 = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
URLSAFE = re.compile(r"[A-Za-z0-9_-]{16,}={0,2}")
# Runs that go on in the next lines; nothing is given back, so a scan is linear.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
# Text between other bytes; no secret and no layer that holds one is shorter.
STRETCH = re.compile(rb"[\t\r\n\x20-\x7e]{12,}")
LITTLE = re.compile(rb"(?:[\t\r\n\x20-\x7e]\x00){12,}")
BIG = re.compile(rb"(?:\x00[\t\r\n\x20-\x7e]){12,}")
UNBROKEN = re.compile(rb"[A-Za-z0-9+/=_%\\\s-]+")

# Bytes of a compressed block that are scanned at once; what is longer is scanned in windows that
# share OVERLAP bytes. An xz block that needs more than twice the memory is left packed and counted.
MAX_UNPACKED = 64 << 20
OVERLAP = 1 << 20
CHUNK = 1 << 20

Span = tuple[str, int, int]
Mapper = Callable[[int, int], tuple[int, int]]


def scan(text: str) -> list[Span]:
    """Spans of the three kinds in one text; matches that are too short are dropped."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def opener(data: bytes | memoryview) -> Callable | None:
    found = PACKED.match(data)
    if not found:
        return None
    if found.group()[:1] == b"\x1f":
        return lambda: zlib.decompressobj(31)
    if found.group()[:1] == b"\x78":
        return lambda: zlib.decompressobj(15)
    if found.group()[:1] == b"B":
        return bz2.BZ2Decompressor
    return lambda: lzma.LZMADecompressor(memlimit=MAX_UNPACKED * 2)


def unpack(data: bytes | memoryview, left: list[int]) -> Iterator[bytes | None]:
    """Content of a compressed block and of the blocks that follow it, in chunks; None if it needs
    too much memory. `left` gets the number of bytes behind the last block."""
    while make := opener(data):
        tool = make()
        while not tool.eof:
            try:
                out = tool.decompress(data, CHUNK)
            except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError) as broken:
                if isinstance(broken, lzma.LZMAError) and "limit" in str(broken):
                    yield None
                return
            data = getattr(tool, "unconsumed_tail", b"")
            if out:
                yield out
            elif not data:
                break
        if not tool.eof:
            return
        data = tool.unused_data.lstrip(b"\0")
        left[:] = [len(data)]


def windows(chunks: Iterator[bytes | None]) -> Iterator[bytes | None]:
    """The chunks as one block, or as overlapping ones if they are more than MAX_UNPACKED bytes; None
    for what can't be read, or holds a run longer than the overlap at a cut."""
    held = bytearray()
    fresh = False
    for chunk in chunks:
        if chunk is None:
            yield None
            continue
        held += chunk
        fresh = True
        while len(held) > MAX_UNPACKED:
            cut = MAX_UNPACKED
            while cut > MAX_UNPACKED - 4 and held[cut] & 0xC0 == 0x80:
                cut -= 1
            yield bytes(held[:cut])
            back = cut - OVERLAP
            if UNBROKEN.fullmatch(held, back, cut):
                yield None
            while back > cut - OVERLAP - 4 and held[back] & 0xC0 == 0x80:
                back -= 1
            del held[:back]
            fresh = len(held) > cut - back
    if fresh:
        yield bytes(held)


def readable(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    plain = sum(c.isprintable() or c in "\t\r\n" for c in text)
    return text if text and plain >= 0.9 * len(text) else None


def replaced(text: str, found: Iterator[re.Match], decode: Callable[[str], str]) -> tuple[str, Mapper] | None:
    """The text with its escapes decoded, and the way back from its places to those of `text`."""
    out: list[str] = []
    pieces: list[tuple[int, int, int, int]] = []  # from, to, source from, source to
    at = size = 0
    for m in found:
        new = decode(m.group())
        if new == m.group():
            continue
        out += [text[at : m.start()], new]
        pieces.append((size, size + m.start() - at, at, m.start()))
        size += m.start() - at
        pieces.append((size, size + len(new), m.start(), m.end()))
        size += len(new)
        at = m.end()
    if not pieces:
        return None
    out.append(text[at:])
    pieces.append((size, size + len(text) - at, at, len(text)))

    filled = [p for p in pieces if p[0] < p[1]]
    starts = [p[0] for p in filled]

    def back(start: int, end: int) -> tuple[int, int]:
        first = filled[bisect.bisect_right(starts, start) - 1]
        last = filled[bisect.bisect_left(starts, end) - 1]
        a = first[2] + start - first[0] if first[1] - first[0] == first[3] - first[2] else first[2]
        b = last[2] + end - last[0] if last[1] - last[0] == last[3] - last[2] else last[3]
        return a, b

    return "".join(out), back


def _percent(run: str) -> str:
    try:
        return bytes.fromhex(run.replace("%", "")).decode("utf-8")
    except UnicodeDecodeError:
        return run


def _escapes(run: str) -> str:
    codes = [int(x, 16) for x in ESCAPED.findall(run)]
    try:
        units = b"".join(chr(c).encode("utf-16-le", "surrogatepass") for c in codes)
        return units.decode("utf-16-le")
    except (ValueError, UnicodeDecodeError):
        return run


def runs(text: str) -> Iterator[tuple[str, tuple[int, int], Callable[[int], int]]]:
    """Runs that may be base64, in the plain alphabet and without padding, each with its span and
    the way from its characters to their places in the text."""
    for m in BASE64.finditer(text):
        yield m.group().rstrip("="), m.span(), lambda i, m=m: m.start() + i
    if "-" in text or "_" in text:
        for m in URLSAFE.finditer(text):
            if "-" in m.group() or "_" in m.group():
                body = m.group().rstrip("=").replace("-", "+").replace("_", "/")
                yield body, m.span(), lambda i, m=m: m.start() + i
    if "\n" in text:
        for m in WRAPPED.finditer(text):
            lines = list(LINE.finditer(text, *m.span()))
            body = "".join(x.group() for x in lines).replace("-", "+").replace("_", "/")
            if len(body) < 16:
                continue
            starts = list(accumulate((len(x.group()) for x in lines[:-1]), initial=0))

            def place(i: int, lines=lines, starts=starts) -> int:
                k = bisect.bisect_right(starts, i) - 1
                return lines[k].start() + i - starts[k]

            yield body, m.span(), place


def byte_form(text: str, found: Iterator[re.Match], decode: Callable[[re.Match], bytes]) -> tuple[bytes, Mapper]:
    """The text as bytes, each escape as what it stands for and any other character as one byte, and
    the way from its bytes to places of `text`."""
    coded = text.encode("latin-1", "replace")
    out: list[bytes] = []
    sizes, places = [0], [0]  # from a byte on, and where that byte stands; both grow by one in between
    at = size = 0
    for m in found:
        new = decode(m)
        out += [coded[at : m.start()], new]
        size += m.start() - at
        wide = (m.end() - m.start()) // len(new)
        for k in range(len(new)):
            sizes.append(size + k)
            places.append(m.start() + k * wide)
        size += len(new)
        at = m.end()
        sizes.append(size)
        places.append(at)
    out.append(coded[at:])

    def place(i: int) -> int:
        k = bisect.bisect_right(sizes, i) - 1
        return places[k] + i - sizes[k]

    return b"".join(out), lambda s, e: (place(s), place(e))


def _escaped_byte(m: re.Match) -> bytes:
    return bytes.fromhex(m[1] or m[2]) if m[1] or m[2] else SHORT_ESCAPES[m[3]]


def below_text(text: str) -> Iterator[tuple[str | bytes, Mapper]]:
    """Layers one below `text`, each with its way back.

    Escapes are decoded as text and, where they stand for bytes that are no text, as bytes. A base64
    run may begin with other letters, such as a path, so it is decoded from each of its first four
    characters.
    """
    if "%" in text:
        if below := replaced(text, PERCENT.finditer(text), _percent):
            yield below
        if any(_percent(m.group()) == m.group() for m in PERCENT.finditer(text)):
            yield byte_form(text, PERCENT.finditer(text), lambda m: bytes.fromhex(m.group().replace("%", "")))
    if "\\" in text:
        if below := replaced(text, ESCAPE.finditer(text), _escapes):
            yield below
        if HIGH_ESCAPE.search(text):
            yield byte_form(text, BYTE_ESCAPE.finditer(text), _escaped_byte)
    for body, span, place in runs(text):
        for off in range(4):
            size = len(body) - off
            size -= size % 4 == 1
            if size < 4:
                continue
            data = base64.b64decode(body[off : off + size] + "=" * (-size % 4))

            def back(s: int, e: int, off=off, body=body, span=span, place=place, n=len(data)) -> tuple[int, int]:
                last = min(len(body), off - (-e * 4 // 3))
                return place(off + s * 4 // 3), span[1] if e == n else place(last - 1) + 1

            yield data, back


def ahead(items: Iterator) -> Iterator[tuple[object, bool]]:
    """The items, each with whether it is the last one."""
    held = next(items, items)
    while held is not items:
        after = next(items, items)
        yield held, after is items
        held = after


def deflated(data: bytes) -> Iterator[bytes]:
    """Content of `data` if all of it is one stream without header, else nothing."""
    for final in (False, True):
        tool = zlib.decompressobj(-15)
        rest = data
        while not tool.eof:
            try:
                out = tool.decompress(rest, CHUNK)
            except zlib.error:
                return
            rest = tool.unconsumed_tail
            if final and out:
                yield out
            elif not out and not rest:
                break
        if not tool.eof or tool.unused_data:
            return


def below_bytes(data: bytes) -> Iterator[tuple[str | bytes, Mapper] | None]:
    """Layers one below `data`: the content of compressed blocks, which may begin anywhere, as bytes;
    the text that the bytes are, or else the texts, of one or two bytes a character, between other
    bytes. None for what can't be unpacked, and for a block that goes on behind a window."""
    whole = [(0, 0)]  # blocks unpacked to their ends
    view = memoryview(data)
    for found in PACKED.finditer(data):
        start = found.start()
        if start < whole[-1][1]:
            continue
        left: list[int] = []
        got = skimmed = False
        for window, last in ahead(windows(unpack(view[start:], left))):
            if window is None:
                yield None
                continue
            got = True
            if not last and not skimmed:  # the block's end is found first
                skimmed = True
                for _ in unpack(view[start:], left):
                    pass
            span = (start, len(data) - left[0] if left else len(data))
            yield window, lambda s, e, span=span: span
        if left:
            whole.append((start, len(data) - left[0]))
        elif got and len(data) >= MAX_UNPACKED - 4:
            yield None
    if (inner := readable(data)) is not None:
        same = len(inner) == len(data)
        yield inner, (lambda s, e: (s, e)) if same else (lambda s, e, n=len(data): (0, n))
        return
    if len(data) >= 12 and len(whole) == 1:
        for window in windows(deflated(data)):
            if window is not None:
                yield window, lambda s, e, n=len(data): (0, n)
            else:
                yield None
    for pattern, width in ((STRETCH, 1), (LITTLE, 2), (BIG, 2)):
        for m in pattern.finditer(data):
            if any(a <= m.start() and m.end() <= b for a, b in whole):
                continue
            letters = m.group()[pattern is BIG :: width].decode()
            yield letters, lambda s, e, at=m.start(), w=width: (at + s * w, at + e * w)


def unwrapped(layer: str | bytes) -> Iterator[tuple[str | bytes, Mapper] | None]:
    return below_text(layer) if isinstance(layer, str) else below_bytes(layer)


def met(layer: str | bytes) -> tuple[bool, str | bytes]:
    """What stands for a layer among those met: itself, or its digest if it is long."""
    text = isinstance(layer, str)
    if len(layer) < 256:
        return text, layer
    raw = layer.encode("utf-8", "surrogatepass") if text else layer
    return text, hashlib.blake2b(raw, digest_size=16).digest()


def find(text: str) -> tuple[list[tuple[str, int, int, int]], int]:
    """All secrets of a text as (kind, start, end, depth), and how often a block could not be read whole.

    Each layer is scanned, then unwrapped; the worklist holds what is still to be unwrapped, one layer
    of each depth at a time. A layer met before at the same place and no deeper is not followed again,
    which ends cycles.
    """
    spans: dict[Span, int] = {}
    seen = {(0, len(text), met(text)): 0}
    oversized = 0
    work: list[tuple[Iterator, Mapper]] = []

    def enter(layer: str | bytes, home: Mapper) -> None:
        depth = len(work)
        for kind, s, e in scan(layer) if isinstance(layer, str) else ():
            key = (kind, *home(s, e))
            spans[key] = min(depth, spans.get(key, depth))
        work.append((unwrapped(layer), home))

    enter(text, lambda s, e: (s, e))
    while work:
        layers, home = work[-1]
        try:
            below = next(layers)
        except StopIteration:
            work.pop()
            continue
        if below is None:
            oversized += 1
            continue
        inner, back = below
        if not inner:
            continue
        place = (*home(*back(0, len(inner))), met(inner))
        if seen.get(place, len(work) + 1) <= len(work):
            continue
        seen[place] = len(work)
        enter(inner, lambda s, e, home=home, back=back: home(*back(s, e)))
    rank = {k: i for i, k in enumerate(KINDS)}
    ordered = sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2]))
    return [(*x, spans[x]) for x in ordered], oversized


SPAN_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("spans", T.ArrayType(SPAN_TYPE)),
        T.StructField("oversized", T.IntegerType()),
    ]
)


@F.pandas_udf(FOUND)
def find_all(texts: pd.Series) -> pd.DataFrame:
    rows = [find(t) for t in texts]
    return pd.DataFrame(
        {
            "spans": [
                [{"kind": k, "start": s, "end": e, "depth": d} for k, s, e, d in r[0]] for r in rows
            ],
            "oversized": [r[1] for r in rows],
        }
    )


def find_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`df` with `secrets` (kind, start, end, depth; code points, end excluded, sorted by start, then
    kind) and `oversized` (compressed blocks that need too much memory or, below a compressed one, go on
    behind a window, and cuts in runs too long for the overlap of two windows).

    Depth 0 is the text itself; deeper spans were found below URL, Unicode, base64 or compressed
    layers and point at the place in the text that holds them. A layer is text or bytes; bytes are
    read as compressed blocks, as UTF-8, and as letters of one or two bytes between other bytes. Null and empty texts have no spans.
    Each row is scanned on its own and whole, in Arrow batches; repeated rows get equal results, and
    columns named secrets or oversized are replaced.
    """
    found = free_names(df, "_found")[0]
    rows = df.select(*without(df, ("secrets", "oversized")), find_all(text_of(text_col)).alias(found))
    return rows.select(
        *without(df, ("secrets", "oversized")),
        col(found)["spans"].alias("secrets"),
        col(found)["oversized"].alias("oversized"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract of query 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("secrets", lambda s: s["depth"] == 0)

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    def shown(name: str):
        return F.transform(
            name,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        )

    return (
        find_secrets(docs)
        .withColumn("base", base)
        .select(
            "doc_id",
            count("assign").alias("n_assign"),
            count("access").alias("n_access"),
            count("hex").alias("n_hex"),
            joined_digest(shown("base")).alias("base_sha256"),
            F.array_join(shown("secrets"), ",").alias("spans"),
            "oversized",
        )
    )
