"""Secrets in texts, with structural confirmation.

Base patterns (assignments, access keys, runs of hexadecimal digits) are reported as they match.
Beyond them, candidates are decoded and reported only if their inside has the structure of a
secret: signed tokens whose header and payload are JSON objects, keys whose ASN.1 elements or
length-prefixed fields nest exactly, and base64 or hexadecimal runs, on one line or wrapped over
several, whose decoded bytes hold an assignment, an access key or, at up to ``NESTED`` levels of
encoding, one of these structures again.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import picked, prepared

# --- fixed values: base patterns, markers of key formats --------------------------------------

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.I | re.A,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
WORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "signed_token", "private_key", "key_blob", "encoded")
OPENSSH = b"openssh-key-v1\x00"
# ASN.1: tags of SEQUENCE, INTEGER, OCTET STRING, and the bit of constructed elements.
SEQUENCE, INTEGER, OCTETS, CONSTRUCTED = 0x30, 0x02, 0x04, 0x20

# ------------------------------------------------------------------------------------------------

_LONG_HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])ey[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END ([A-Z0-9 ]*)PRIVATE KEY-----")
# The smallest secret, "token=" and six characters, has 12 bytes: 16 characters or 24 digits.
_RUN_LEAST = 16
_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{_RUN_LEAST},}}={{0,2}}")
_ANY_HEX = re.compile(r"[0-9a-fA-F]{24,}")
# Line breaks, also as they are written inside quoted strings.
_BREAK = r"[\x20\t]*(?:\r?\n|\\r\\n|\\n)[\x20\t]*"
_BREAKS = re.compile(_BREAK)
_WRAPPED = re.compile(
    rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:{_BREAK}[A-Za-z0-9+/_-]++)+={{0,2}}"
)
_HEADER = re.compile(r"^[A-Za-z-]+:.*$", re.M)
_CONTROLS = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_DEPTH = 16
# Levels of encoding inside a decoded text that are looked through.
NESTED = 4

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, leftmost and not overlapping within a kind."""
    spans: list[Span] = []
    lowered = text.lower()
    if any(word in lowered for word in WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                spans.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                spans.append(("access", m.start(), m.end()))
    spans.extend(("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text))
    return spans


def unbase64(run: str) -> bytes | None:
    """The bytes of a base64 or base64url run; None if it is none."""
    plain = run.rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except binascii.Error:
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the ASN.1 element at a place; None if it overruns."""
    if at + 2 > end:
        return None
    tag, length, start = data[at], data[at + 1], at + 2
    if length & 0x80:
        size = length & 0x7F
        if not 1 <= size <= 4 or start + size > end:
            return None
        length = int.from_bytes(data[start : start + size], "big")
        start += size
    return (tag, start, start + length) if start + length <= end else None


def nests(data: bytes, at: int, end: int, depth: int = 0) -> list[int] | None:
    """Tags of the elements between two places if all lengths nest exactly, else None."""
    tags = []
    while at < end:
        element = _element(data, at, end)
        if element is None or depth > _DEPTH:
            return None
        tag, start, stop = element
        if tag & CONSTRUCTED and nests(data, start, stop, depth + 1) is None:
            return None
        tags.append(tag)
        at = stop
    return tags


def is_asn1_key(data: bytes) -> bool:
    """A SEQUENCE that fills the data and begins with a version, as private keys do."""
    whole = _element(data, 0, len(data))
    if whole is None or whole[0] != SEQUENCE or whole[2] != len(data):
        return False
    tags = nests(data, whole[1], whole[2])
    if not tags or len(tags) < 3 or tags[0] != INTEGER:
        return False
    # Version and numbers, version and octets, or version, algorithm and octets.
    return len(tags) >= 6 and set(tags) == {INTEGER} or tags[1] == OCTETS or tags[2] == OCTETS


def is_openssh_key(data: bytes) -> bool:
    """Length-prefixed names of cipher and derivation, options, a count, and that many keys."""
    if not data.startswith(OPENSSH):
        return False
    at = len(OPENSSH)
    for _ in range(3):
        length = int.from_bytes(data[at : at + 4], "big")
        at += 4 + length
        if at > len(data):
            return False
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    for _ in range(min(count, 16) + 1):
        length = int.from_bytes(data[at : at + 4], "big")
        at += 4 + length
        if at > len(data):
            return False
    return count > 0


def is_key(data: bytes) -> bool:
    return is_asn1_key(data) or is_openssh_key(data)


def is_signed_token(run: str) -> bool:
    parts = [unbase64(part) for part in run.split(".")[:2]]
    try:
        header, payload = (json.loads(part or b"") for part in parts)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict)


def hidden(data: bytes, nested: int = NESTED) -> list[tuple[int, int]]:
    """Places in the bytes of assignments, access keys and confirmed structures.

    All of these are ASCII. Other bytes, UTF-8 or not, only separate.
    """
    text = data.decode("latin-1")
    found = [(a, b) for kind, a, b in base_spans(text) if kind != "hex"]
    if nested:
        found += [(a, b) for _, a, b in confirmed_spans(text, nested - 1)]
    return found


def _is_text(data: bytes) -> bool:
    try:
        return not _CONTROLS.search(data.decode("utf-8"))
    except UnicodeDecodeError:
        return False


def _base64_kind(run: str, nested: int) -> str | None:
    """Kind of what a base64 run hides; what is glued to its ends may shift it."""
    whole = run.rstrip("=")
    for skip in range(4):
        part = whole[skip:]
        exact = unbase64(part)
        if exact and is_key(exact):
            return "key_blob"
        data = unbase64(part[:-1]) if exact is None else exact
        if data and hidden(data, nested):
            return "encoded"
    return None


def _hex_kind(digits: str, nested: int) -> str | None:
    """Kind of what hexadecimal digits hide, from their first or their second one on."""
    for skip in range(2):
        data = bytes.fromhex(digits[skip : skip + (len(digits) - skip) // 2 * 2])
        if is_key(data):
            return "key_blob"
        if hidden(data, nested):
            return "encoded"
    return None


def _run_spans(m: re.Match, nested: int) -> list[Span]:
    kind = _base64_kind(m[0], nested)
    if kind:
        return [(kind, m.start(), m.end())]
    digits = ((h, _hex_kind(h[0], nested)) for h in _ANY_HEX.finditer(m[0]))
    return [(kind, m.start() + h.start(), m.start() + h.end()) for h, kind in digits if kind]


def _choices(lines: list[str]) -> list[tuple[int, int]]:
    """First and last of lines that may be one wrapped run, longest first.

    All lines, all but the outer ones, which may be words beside the run, and lines of one width
    with a shorter last one.
    """
    last = len(lines) - 1
    found = {(0, last), (0, last - 1), (1, last), (1, last - 1)}
    first = 0
    while first < last:
        width, final = len(lines[first]), first
        while final < last and len(lines[final + 1]) == width:
            final += 1
        if width >= _RUN_LEAST:
            found.add((first, final))
            if final < last and len(lines[final + 1]) < width:
                found.add((first, final + 1))
        first = final + 1
    return sorted(((a, b) for a, b in found if a < b), key=lambda c: (c[0] - c[1], c))


def _wrapped_spans(m: re.Match, nested: int) -> list[Span]:
    """Spans of runs that are wrapped over lines of a match."""
    breaks = list(_BREAKS.finditer(m[0]))
    starts, ends = [0, *(b.end() for b in breaks)], [*(b.start() for b in breaks), len(m[0])]
    lines = [m[0][a:b] for a, b in zip(starts, ends)]
    found: list[Span] = []

    def add(kind: str, first: int, final: int) -> None:
        alone = (_RUN.fullmatch(line) for line in lines[first : final + 1])
        if not all(run and _run_spans(run, nested) for run in alone):
            found.append((kind, m.start() + starts[first], m.start() + ends[final]))

    settled = bytearray(len(lines))
    for first, final in _choices(lines):
        if 1 in settled[first : final + 1]:
            continue
        run = "".join(lines[first : final + 1])
        if len(run) < _RUN_LEAST:
            continue
        decoded = [unbase64(run)]
        digits = run[2:] if run[:2] in ("0x", "0X") else run
        if _ANY_HEX.fullmatch(digits) and len(digits) % 2 == 0:
            decoded.append(bytes.fromhex(digits))
        decoded = [data for data in decoded if data and (is_key(data) or _is_text(data))]
        if not decoded:
            continue
        settled[first : final + 1] = b"\1" * (final + 1 - first)
        if any(is_key(data) for data in decoded):
            add("key_blob", first, final)
        elif any(hidden(data, nested) for data in decoded):
            add("encoded", first, final)
    # What is neither as a whole: the lines that hold something, however the run begins and ends.
    run = "".join(lines).rstrip("=")
    if len(run) < _RUN_LEAST:
        return found
    offsets = list(accumulate(map(len, lines), initial=0))
    places = set()
    for skip in range(4):
        part = run[skip:]
        data = unbase64(part[: -1 if len(part) % 4 == 1 else None])
        for a, b in hidden(data, nested) if data else ():
            places.add((skip + a * 4 // 3, skip + (b * 4 + 2) // 3))
    for h in _ANY_HEX.finditer(run):
        for skip in range(2):
            at = h.start() + skip
            data = bytes.fromhex(run[at : at + (h.end() - at) // 2 * 2])
            places.update((at + 2 * a, at + 2 * b) for a, b in hidden(data, nested))
    spread = {(bisect_right(offsets, a) - 1, bisect_left(offsets, b) - 1) for a, b in places}
    for first, final in sorted(spread):
        final = min(final, len(lines) - 1)
        if first < final and 1 not in settled[first : final + 1]:
            add("encoded", first, final)
    return found


def _pem_blocks(text: str) -> Iterator[tuple[int, int, int, int]]:
    """Start, inner start, inner end and end of each block, in order and without overlap.

    The marks are collected once and paired by bisection, so beginnings without an end cost
    nothing more.
    """
    stops: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for m in _PEM_END.finditer(text):
        stops[m[1]].append(m.span())
    done = 0
    for m in _PEM_BEGIN.finditer(text):
        known = stops.get(m[1], [])
        at = bisect_left(known, (m.end(), 0))
        if m.start() >= done and at < len(known):
            stop, done = known[at]
            yield m.start(), m.end(), stop, done


def confirmed_spans(text: str, nested: int = NESTED) -> list[Span]:
    """Spans whose decoded structure confirms a secret; none inside another of a key or run."""
    spans: list[Span] = []
    if "ey" in text and "." in text:
        for m in _TOKEN.finditer(text):
            if is_signed_token(m[0]):
                spans.append(("signed_token", m.start(), m.end()))
    within = bytearray(len(text))
    whole: list[Span] = []
    if "PRIVATE KEY-----" in text:
        for start, inner, stop, end in _pem_blocks(text):
            data = unbase64("".join(_HEADER.sub("", _BREAKS.sub("\n", text[inner:stop])).split()))
            # An encrypted key has headers of its own instead of a readable structure.
            if data and (is_key(data) or "ENCRYPTED" in text[start:end]):
                whole.append(("private_key", start, end))
                within[start:end] = b"\1" * (end - start)
    for m in _WRAPPED.finditer(text):
        if within.find(0, m.start(), m.end()) >= 0:
            whole += _wrapped_spans(m, nested)
    for _, start, end in whole:
        within[start:end] = b"\1" * (end - start)
    for m in _RUN.finditer(text):
        if within.find(0, m.start(), m.end()) >= 0:
            spans += _run_spans(m, nested)
    return spans + whole


def spans_of(text: str | None) -> list[Span]:
    """All spans in order of their start, then their kind; none for NULL."""
    if not text:
        return []
    found = set(base_spans(text)) | set(confirmed_spans(text))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


@F.pandas_udf(T.ArrayType(_SPAN))
def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series(
        [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t)] for t in texts],
        dtype=object,
    )


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key`` and spans, an array of kind, start and end.

    Places are code points, the end is exclusive. NULL and empty texts have no spans; long texts
    are read whole, in time proportional to their length; repeated rows are done one by one. No
    documents give no rows. Other columns are left out and may have any name.
    """
    prepared(docs.sparkSession)
    rows = picked(docs, _key=key, _text=text)
    return rows.select(F.col("_key").alias(key), _spans("_text").alias("spans"))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``, columns as they are."""

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([_without(t, mark) for t in texts], dtype=object)

    return docs.withColumn(text, clean(F.col(text)))


def _without(text: str | None, mark: str) -> str | None:
    if not text:
        return text
    parts, at = [], 0
    for _, start, end in spans_of(text):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])
