"""Secret scan with structural confirmation.

Three base patterns find assignments, access keys and long hex runs. Beyond them, every
base64, base64url or hex candidate is decoded and parsed, and reported only when the bytes
have the structure of a secret:

* ``jwt``: three base64url parts; the header decodes to a JSON object with a string ``alg``,
  the claims to a JSON object, and the signature is not empty unless ``alg`` is ``none``.
* ``der``: a private key in DER (PKCS#1, PKCS#8, encrypted PKCS#8 or SEC 1). Every nested
  length has to fill its parent exactly.
* ``ssh``: an OpenSSH private key, whose length-prefixed fields have to fit the blob.

Defined results: null text is empty; an empty text has no spans; repeated rows are scanned
one by one; spans that start together are told apart by kind; an empty table gives no rows;
extra columns pass through, and a column named like a new one is replaced. Texts are scanned
whole: of a candidate in wrapped lines, only the headers at its start are decoded until they
agree with a key, so the time follows the length of the text.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns, texts_of

Span = tuple[int, int, str]

KINDS = ("assign", "access", "hex", "jwt", "der", "ssh")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

# The base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_MIN_ASSIGNED = 6

# A whole run at a time, so that no start within it is tried again.
_DOTTED = re.compile(r"[A-Za-z0-9_.-]++")
# Runs of one alphabet, perhaps wrapped into lines as in PEM files. Every confirmed
# structure takes at least 32 encoded characters.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
_HEXES = re.compile(r"[0-9A-Fa-f]{48,}")
_SSH_MAGIC = b"openssh-key-v1\0"
_SEQUENCE, _INTEGER, _OCTETS, _OID = 0x30, 0x02, 0x04, 0x06
_AFTER_VERSION = (_INTEGER, _OCTETS, _SEQUENCE)


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value of the DER element at ``at``, if it fits."""
    if at + 2 > end:
        return None
    tag, first = data[at], data[at + 1]
    at += 2
    if first < 0x80:
        length = first
    else:
        n = first & 0x7F
        if not 1 <= n <= 4 or at + n > end or data[at] == 0:
            return None
        length = int.from_bytes(data[at : at + n], "big")
        at += n
        if length < 0x80:
            return None
    return (tag, at, at + length) if at + length <= end else None


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start:end`` exactly."""
    found = []
    while start < end:
        element = _tlv(data, start, end)
        if element is None:
            return None
        found.append(element)
        start = element[2]
    return found


def _is_algorithm(data: bytes, element: tuple[int, int, int]) -> bool:
    parts = _elements(data, *element[1:]) if element[0] == _SEQUENCE else None
    return bool(parts) and parts[0][0] == _OID and parts[0][2] > parts[0][1]


def is_private_key_der(data: bytes) -> bool:
    """Whether ``data`` is one private key whose nested lengths all agree."""
    top = _tlv(data, 0, len(data))
    if top is None or top[0] != _SEQUENCE or top[2] != len(data):
        return False
    parts = _elements(data, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    if len(parts) == 2 and _is_algorithm(data, parts[0]):
        return tags[1] == _OCTETS and parts[1][2] - parts[1][1] >= 16
    if len(parts) < 2 or tags[0] != _INTEGER or parts[0][2] - parts[0][1] != 1:
        return False
    version = data[parts[0][1]]
    if len(parts) >= 9 and version in (0, 1) and set(tags[:9]) == {_INTEGER}:
        return parts[1][2] - parts[1][1] >= 32
    if tags[1] == _OCTETS and version == 1:
        return parts[1][2] - parts[1][1] >= 16 and all(t & 0xE0 == 0xA0 for t in tags[2:])
    if len(parts) >= 3 and version in (0, 1) and _is_algorithm(data, parts[1]):
        return tags[2] == _OCTETS and parts[2][2] > parts[2][1]
    return False


def is_openssh_key(data: bytes) -> bool:
    """Whether ``data`` is one OpenSSH private key: magic, then length-prefixed fields."""
    if not data.startswith(_SSH_MAGIC):
        return False
    at = len(_SSH_MAGIC)

    def field() -> int | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        length = int.from_bytes(data[at : at + 4], "big")
        at += 4 + length
        return length if at <= len(data) else None

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 64 or any(not field() for _ in range(keys)):
        return False
    private = field()
    return private is not None and private >= 8 and at == len(data)


def _decoded(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without padding."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = _decoded(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _is_signed_token(token: str) -> bool:
    header, claims, signature = token.split(".")
    head = _json_object(header)
    if head is None or not isinstance(head.get("alg"), str) or _json_object(claims) is None:
        return False
    return head["alg"].lower() == "none" or bool(signature) and _decoded(signature) is not None


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    if is_openssh_key(data):
        return "ssh"
    return "der" if data[0] == _SEQUENCE and is_private_key_der(data) else None


def _signed_tokens(run: str, at: int) -> Iterator[Span]:
    """Signed tokens in a run of base64url parts and dots.

    A header may be glued to other characters; then it starts at its last ``eyJ``, which is
    how a JSON object with a quoted first key begins.
    """
    parts = run.split(".")
    for i in range(len(parts) - 2):
        header, claims, signature = parts[i : i + 3]
        starts = sorted({0, max(0, header.rfind("eyJ"))})
        for start in starts if claims else ():
            if _is_signed_token(f"{header[start:]}.{claims}.{signature}"):
                yield at + start, at + len(header) + len(claims) + len(signature) + 2, "jwt"
                break
        at += len(header) + 1


def _structured(text: str) -> Iterator[Span]:
    for match in _DOTTED.finditer(text):
        if match.group().count(".") > 1:
            yield from _signed_tokens(match.group(), match.start())
    for match in _BASE64.finditer(text):
        whole = match.group()
        kind = _key_kind(_decoded("".join(whole.split())))
        if kind:
            yield match.start(), match.end(), kind
        elif "\n" in whole:  # the run may join a key with lines of other text
            yield from _in_lines(whole, match.start())
    for match in _HEXES.finditer(text):
        run = match.group()
        kind = _key_kind(bytes.fromhex(run)) if len(run) % 2 == 0 else None
        if kind:
            yield match.start(), match.end(), kind


def _in_lines(run: str, at: int) -> Iterator[Span]:
    """Keys that start at a line of ``run`` and end with a line.

    The first bytes name the key's length, so each start is tried with one end only, and
    only if the headers that lie at its start agree with a key. The lines are joined once.
    """
    lines = [(m.start(), m.end()) for m in re.finditer(r"[^\r\n]+", run)]
    whole = "".join(run[s:e] for s, e in lines)
    ends = list(accumulate(e - s for s, e in lines))
    i = 0
    while i < len(lines):
        first = ends[i - 1] if i else 0
        size = _outer_size(whole, first)
        last = bisect_left(ends, first + (size * 4 + 2) // 3) if size else len(lines)
        kind = _key_kind(_decoded(whole[first : ends[last]])) if last < len(lines) else None
        if kind:
            yield at + lines[i][0], at + lines[last][1], kind
        i = last + 1 if kind else i + 1


def _bytes_at(whole: str, first: int, at: int, n: int) -> bytes:
    """Bytes ``at`` to ``at + n`` of the base64 that starts at ``first``; fewer at its end."""
    low = at // 3
    text = whole[first + 4 * low : first + 4 * ((at + n + 2) // 3)]
    return (_decoded(text) or b"")[at - 3 * low :][:n]


def _outer_size(whole: str, first: int) -> int | None:
    """Length of the key whose base64 starts at ``first``; None if its headers are no key's.

    Only headers are decoded, so the time does not depend on the length that they name.
    """
    head = _bytes_at(whole, first, 0, len(_SSH_MAGIC))
    if head == _SSH_MAGIC:
        at = len(head)

        def skip() -> int:
            nonlocal at
            length = _bytes_at(whole, first, at, 4)
            at += 4 + int.from_bytes(length, "big")
            return len(length) == 4

        if not all(skip() for _ in range(3)):
            return None
        keys = int.from_bytes(_bytes_at(whole, first, at, 4), "big")
        at += 4
        return at if 1 <= keys <= 64 and all(skip() for _ in range(keys + 1)) else None
    if head[:1] != bytes([_SEQUENCE]) or len(head) < 2:
        return None
    n = head[1] & 0x7F if head[1] >= 0x80 else 0
    if n > 4:
        return None
    body = 2 + n
    size = body + (int.from_bytes(head[2:body], "big") if n else head[1])
    inner = _bytes_at(whole, first, body, 4)
    if inner[:2] == bytes([_INTEGER, 1]):  # a version, then a key's first part
        plain = inner[2:3] in (b"\0", b"\1") and inner[3:] and inner[3] in _AFTER_VERSION
        return size if plain else None
    return size if inner[:1] == bytes([_SEQUENCE]) else None


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, by start and then kind."""
    spans = [
        (m.start(), m.end(), "assign")
        for m in _ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= _MIN_ASSIGNED
    ]
    spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=_by_start)


def _by_start(span: Span) -> tuple[int, int, int]:
    return span[0], _ORDER[span[2]], span[1]


def find_secrets(text: str) -> list[Span]:
    """All spans of one text: the base ones and the structurally confirmed ones."""
    return sorted({*base_spans(text), *_structured(text)}, key=_by_start)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``secrets``, an array of (kind, start, end) in code points, end exclusive."""
    new = T.StructType().add(
        "secrets",
        T.ArrayType(
            T.StructType().add("kind", "string").add("start", "long").add("end", "long")
        ),
    )

    def compute():
        def step(columns: list[pa.Array]) -> list:
            return [
                [
                    [{"kind": k, "start": s, "end": e} for s, e, k in find_secrets(t)]
                    for t in texts_of(columns[0])
                ]
            ]

        return step

    return append_columns(docs, [text], new, compute)


def secret_digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add counts of the base spans, their digest, and all spans as one string."""
    new = (
        T.StructType()
        .add("n_assign", "long")
        .add("n_access", "long")
        .add("n_hex", "long")
        .add("base_sha256", "string")
        .add("spans", "string")
    )

    def compute():
        def step(columns: list[pa.Array]) -> list:
            rows = []
            for value in texts_of(columns[0]):
                every = find_secrets(value)
                base = [s for s in every if _ORDER[s[2]] < 3]
                counts = [sum(s[2] == k for s in base) for k in KINDS[:3]]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*counts, digest, _joined(every)))
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 5

        return step

    return append_columns(docs, [text], new, compute)


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its first kind."""
    parts, at, covered = [], 0, 0
    for start, end, kind in spans:
        if start >= covered:
            parts += [text[at:start], f"[{kind} removed]"]
        covered = max(covered, end)
        at = covered
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every secret in ``text``; rows and other columns stay, null text too."""
    new = T.StructType().add(text, "string")

    def compute():
        def step(columns: list[pa.Array]) -> list:
            return [[x and redacted(x, find_secrets(x)) for x in columns[0].to_pylist()]]

        return step

    return append_columns(docs, [text], new, compute).select(*[f"`{c}`" for c in docs.columns])
