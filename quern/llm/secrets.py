"""Secret scans with a worklist of decoded layers.

The text is the first layer. Each layer is scanned for secrets; what it holds in URL or Unicode escapes, base64, or
base64 of gzip, zlib or zstandard data, packed once or more, becomes a further layer, until no new layer appears. Layers seen before in the
document are not scanned again, which ends cycles. Every character of a layer maps to a span of the document's text, so a
secret in a layer is reported where the text that hides it stands. A run of base64 may begin or end with other letters, so
it is read from each of its first four places, and so are its parts between slashes, dashes and underscores.

Null texts count as empty. Repeated rows are each scanned; an empty table gives an empty result; extra columns stay,
but those named like a result are replaced. Only decompression makes a layer larger than
what holds it: a packed layer of over MOST_DECODED bytes, as a decompression bomb makes it, stays packed, `bomb` says so,
and the pipeline masks it whole. Every other layer is decoded, one at a time from the innermost, however many they are.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, read_table, with_fields

KINDS = ("assign", "access", "hex")
#: The base patterns: fixed values.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_SECRET = 12
MOST_DECODED = 64 << 20

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|%u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U000[0-9A-Fa-f]{5}|\\U0010[0-9A-Fa-f]{4}|&#x[0-9A-Fa-f]{1,5};|&#[0-9]{1,6};")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+[ \t]*\r?\n[ \t]*)+[A-Za-z0-9+/_-]+={0,2}")
#: Groups of eight with a space between; what ends a part of a run.
GROUPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{8} ){2,}[A-Za-z0-9+/_-]{1,8}={0,2}(?![A-Za-z0-9+/_-])")
PART = re.compile(r"[A-Za-z0-9+]{16,}={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
#: What no text has: control characters but white space, and what stands for bytes that aren't UTF-8.
NO_TEXT = re.compile("[\0-\x08\x0e-\x1f\x7f\ufffd]")
ASCII = re.compile("[ -~]{%d}" % LEAST_SECRET)
STRETCH = re.compile("[^\0-\x08\x0e-\x1f\x7f\ufffd]{%d,}" % LEAST_SECRET)


def base_matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns. A run of capitals and digits or of hex signs is one match of its kind, so asking for its length within the pattern drops the same matches."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_SECRET]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Layer:
    """A decoded text and where it comes from: the places `at` of the text begin stretches of the layer below from `start`, copied, or up to `end` where that isn't -1; whole: all comes from that span of the document."""

    def __init__(self, text: str, below: Layer | None = None, places: tuple[array, array, array] | None = None, whole: tuple[int, int] | None = None):
        self.text, self.below, self.places, self.whole = text, below, places, whole

    def source(self, i: int) -> tuple[int, int]:
        at, start, end = self.places
        k = bisect_right(at, i) - 1
        return (start[k], end[k]) if end[k] >= 0 else (start[k] + i - at[k], start[k] + i - at[k] + 1)

    def span(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while not layer.whole and layer.below:
            start, end = layer.source(start)[0], layer.source(end - 1)[1]
            layer = layer.below
        return layer.whole or (start, end)


def unescaped(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with each match of the pattern decoded, or None if nothing decodes."""
    parts, places, at, n = [], (array("q"), array("q"), array("q")), 0, 0

    def add(part: str, *source: int) -> None:
        nonlocal n
        if part:
            for column, x in zip(places, (n, *source), strict=True):
                column.append(x)
            parts.append(part)
            n += len(part)

    for m in pattern.finditer(layer.text):
        pieces = decode(m[0])  # (decoded character, offset and end within the match)
        if pieces is None:
            continue
        add(layer.text[at : m.start()], at, -1)
        for c, a, b in pieces:
            add(c, m.start() + a, m.start() + b)
        at = m.end()
    if not parts:
        return None
    add(layer.text[at:], at, -1)
    return Layer("".join(parts), layer, places, layer.whole)


def url_decoded(run: str) -> list[tuple[str, int, int]] | None:
    """The valid UTF-8 of a run of percent escapes decoded, other bytes as they stand; None if all stand."""
    data, out, i, decoded = bytes.fromhex(run.replace("%", "")), [], 0, False
    while i < len(data):
        n = 1 if data[i] < 0x80 else 2 if data[i] < 0xE0 else 3 if data[i] < 0xF0 else 4
        try:
            out.append((data[i : i + n].decode(), 3 * i, 3 * min(i + n, len(data))))
            decoded = True
        except UnicodeDecodeError:
            n = 1
            out += [(run[j], j, j + 1) for j in range(3 * i, 3 * i + 3)]
        i += n
    return out if decoded else None


def unicode_decoded(escape: str) -> list[tuple[str, int, int]] | None:
    code = int(escape[2:-1]) if escape[:2] == "&#" and escape[2] != "x" else int(escape[3:-1], 16) if escape[0] == "&" or escape[2] == "{" else int(escape[2:], 16)
    if not 0 < code < 0x110000 or 0xD800 <= code < 0xE000:
        return None
    return [(chr(code), 0, len(escape))]


class TooLarge(Exception):
    """Packed data holds more than may still be decoded."""


def inflated(data: bytes, most: int) -> bytes | None:
    """All members or frames of gzip, zlib or zstandard data unpacked, in steps, as far as they are whole; None if it is none of these. Raises TooLarge beyond `most` bytes, having made few more."""
    out = bytearray()
    try:
        if data[:4] == b"\x28\xb5\x2f\xfd":
            with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as stream:
                while len(out) <= most and (part := stream.read(1 << 18)):
                    out += part
        elif data[:2] == b"\x1f\x8b" or (data[:1] == b"\x78" and len(data) > 1 and (data[0] * 256 + data[1]) % 31 == 0):
            while data and len(out) <= most:
                stream = zlib.decompressobj(47)
                while data and len(out) <= most and not stream.eof:
                    out += stream.decompress(data, 1 << 18)
                    data = stream.unconsumed_tail
                data = stream.unused_data.lstrip(b"\0")
        else:
            return None
    except (zlib.error, zstandard.ZstdError):
        if not out:
            return None
    if len(out) > most:
        raise TooLarge
    return bytes(out)


def deflated(data: bytes, most: int) -> bytes | None:
    """What raw deflate data holds, which no mark begins: None unless it is whole and holds text only. Raises TooLarge as inflated() does."""
    stream, out = zlib.decompressobj(-15), bytearray()
    try:
        while data and len(out) <= most and not stream.eof:
            out += stream.decompress(data, 1 << 18)
            data = stream.unconsumed_tail
    except zlib.error:
        return None
    if len(out) > most:
        raise TooLarge
    return bytes(out) if stream.eof and not stream.unused_data and len(out) >= LEAST_SECRET and not NO_TEXT.search(out.decode("utf-8", "replace")) else None


def wide(data: bytes) -> str | None:
    """data as UTF-16 text, with a mark or without; None if it doesn't look so, or shows no stretch of ASCII as long as a secret: mostly, one byte of two is 0."""
    if len(data) % 2 or len(data) < 2 * LEAST_SECRET:
        return None
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        order = "utf-16"
    elif 2 * data[1::2].count(0) > len(data[1::2]):
        order = "utf-16-le"
    elif 2 * data[::2].count(0) > len(data[::2]):
        order = "utf-16-be"
    else:
        return None
    try:
        text = data.decode(order)
    except UnicodeDecodeError:
        return None
    return text if ASCII.search(text) and not NO_TEXT.search(text) else None


def as_text(data: bytes) -> str | None:
    """data as UTF-8 or UTF-16 text; of other data, the stretches of text long enough for a secret, NUL between them; None if it has none."""
    if (text := wide(data)) is not None:
        return text
    text = data.decode("utf-8", "replace")
    if not NO_TEXT.search(text):
        return text or None
    return "\0".join(STRETCH.findall(text)) or None


def from_base64(run: str, most: int) -> str | None:
    """The text that a run of base64 holds, unpacked as often as it is packed; None if it holds none."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]  # one letter more tells nothing
    try:
        data = base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return None
    seen = set()  # some packed data holds itself
    while (packed := inflated(data, most)) is not None and (key := hashlib.sha256(packed).digest()) not in seen:
        seen.add(key)
        data = packed
    text = as_text(data)
    if (text is None or "\0" in text) and (packed := deflated(data, most)) is not None:
        return as_text(packed)
    return text


def base64_runs(text: str) -> Iterator[tuple[str, int, int]]:
    """(run, start, end) of base64: within a line, in groups with spaces between, and joined over consecutive lines of one length and a last one that isn't longer."""
    for m in BASE64.finditer(text):
        yield m[0], *m.span()
    for m in GROUPED.finditer(text) if " " in text else ():
        yield m[0].replace(" ", ""), *m.span()
    for m in WRAPPED.finditer(text) if "\n" in text else ():
        lines: list[re.Match] = []
        for x in chain(LINE.finditer(text, *m.span()), [None]):
            if lines and (x is None or len(x[0]) > len(lines[0][0]) or len(lines[-1][0]) < len(lines[0][0])):
                if len(lines) > 1:
                    yield "".join(y[0] for y in lines), lines[0].start(), lines[-1].end()
                lines = []
            lines.append(x)


def within_run(run: str) -> Iterator[tuple[str, int, int]]:
    """(part, start, end) of a run of base64 that may have other letters before it, or at which such a run ends: from its second, third and fourth place, and what stands between slashes, dashes and underscores, from its first four."""
    for k in (1, 2, 3):
        yield run[k:], k, len(run)
    for m in PART.finditer(run):
        for k in range(4 if m.span() != (0, len(run)) else 0):
            if m.end() - m.start() - k >= 16:
                yield m[0][k:], m.start() + k, m.end()


def inner_layers(layer: Layer, most: int, refused: set[tuple[int, int]]) -> Iterator[Layer]:
    """What a layer holds, one by one; the spans of what stays packed, as it is larger than `most`, are added to refused."""
    if "%" in layer.text and (x := unescaped(layer, URL, url_decoded)):
        yield x
    if ("\\" in layer.text or "&#" in layer.text or "%u" in layer.text) and (x := unescaped(layer, UNICODE, unicode_decoded)):
        yield x
    for run, start, end in base64_runs(layer.text):
        span = layer.span(start, end)
        try:
            inner = from_base64(run, most)
        except TooLarge:  # this one stays packed, the others are still decoded
            refused.add(span)
            continue
        if inner is not None:
            yield Layer(inner, whole=span)
        if end - start != len(run) or inner is not None and wholly(inner, run):
            continue
        for part, a, b in within_run(run):
            try:
                inner = from_base64(part, most)
            except TooLarge:
                refused.add(layer.span(start + a, start + b))
                continue
            # read from a wrong place, bytes hold short stretches of text by chance
            if inner is not None and (wholly(inner, part) or base_matches(inner)):
                yield Layer(inner, whole=layer.span(start + a, start + b))


def wholly(inner: str, run: str) -> bool:
    """Whether what a run holds is about all of its bytes, or more."""
    return 5 * len(inner.encode("utf-8", "replace")) >= 3 * len(run)


def scan(text: str, most: int = MOST_DECODED) -> tuple[list[tuple[int, int, int]], set[tuple[int, int, int]], int, set[tuple[int, int]]]:
    """Base matches, all matches of all layers as (start, kind number, end) in the text, the number of layers, and the spans of packed layers of over `most` bytes, which stay packed."""
    base = base_matches(text)
    found, layers, refused = set(base), 1, set()
    # most texts have nothing to decode
    if not ("%" in text or "\\" in text or "&#" in text or BASE64.search(text) or GROUPED.search(text)):
        return base, found, layers, refused
    seen = {hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()}
    work = [inner_layers(Layer(text), most, refused)]
    while work:
        if (x := next(work[-1], None)) is None:
            work.pop()
            continue
        key = hashlib.sha256(x.text.encode("utf-8", "surrogatepass")).digest() + repr(x.whole).encode()
        if key in seen:
            continue
        seen.add(key)
        layers += 1
        for start, kind, end in base_matches(x.text):
            s, e = x.span(start, end)
            found.add((s, kind, e))
        work.append(inner_layers(x, most, refused))
    return base, found, layers, refused


def find_secrets(text: str, most: int = MOST_DECODED) -> tuple[list[tuple[int, int, int]], set[tuple[int, int, int]], int, bool]:
    """As scan, but whether anything stays packed."""
    base, found, layers, refused = scan(text, most)
    return base, found, layers, bool(refused)


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
PACKED = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def add_secrets(documents: DataFrame) -> DataFrame:
    """documents with secrets (kind, start, end in code points, end exclusive; base: whether the plain text shows it) ordered by start, kind and end, layers int, bomb boolean and packed, the spans that bombs stand in."""
    bounded_batches(documents.sparkSession)
    documents = documents.drop("secrets", "layers", "bomb", "packed")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            secrets, layers, packed = [], [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                base, found, n, refused = scan(text or "")
                base = set(base)
                secrets.append([{"kind": KINDS[k], "start": s, "end": e, "base": (s, k, e) in base} for s, k, e in sorted(found)])
                layers.append(n)
                packed.append([{"start": s, "end": e} for s, e in sorted(refused)])
            batch = batch.append_column("secrets", pa.array(secrets, pa.list_(SPAN)))
            yield batch.append_column("layers", pa.array(layers, pa.int32())).append_column("bomb", pa.array([bool(x) for x in packed], pa.bool_())).append_column("packed", pa.array(packed, pa.list_(PACKED)))

    kinds = {"secrets": "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>", "layers": "int", "bomb": "boolean", "packed": "array<struct<start:bigint,end:bigint>>"}
    return documents.mapInArrow(scanned, with_fields(documents.schema, **kinds))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = add_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("secrets", lambda x: x["base"])
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["base"] & (x["kind"] == kind))).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined("secrets").alias("spans"), "layers", "bomb",
    )


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with each stretch of secrets, or of what stays packed, in their text replaced by [secret]; n_chars, where there is one, is counted anew."""
    bounded_batches(docs.sparkSession)
    columns = docs.columns

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, texts = batch.schema.get_field_index("text"), []
            for text in batch.column(at).to_pylist():
                _, found, _, refused = scan(text or "")
                stretches: list[list[int]] = []
                for start, end in sorted(chain(((s, e) for s, _, e in found), refused)):
                    if stretches and start <= stretches[-1][1]:
                        stretches[-1][1] = max(stretches[-1][1], end)
                    else:
                        stretches.append([start, end])
                for s, e in reversed(stretches):
                    text = text[:s] + "[secret]" + text[e:]
                texts.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(masked, docs.schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)
