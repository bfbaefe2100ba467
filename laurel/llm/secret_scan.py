"""Secret scan: pattern candidates and structural confirmation of encoded keys and tokens.

Pattern spans are reported as they are.  Further candidates are reported only when their structure holds: a base64 or hex string
decodes to DER whose nested lengths add up and which looks like a key, an OpenSSH key blob whose length fields fill it exactly, or a
signed token whose header is a JSON object that names an algorithm.  Lines of base64 may be indented, joined by blanks or by escaped
line breaks (\\n in JSON), and may touch the -----BEGIN and -----END of their frame.

Spans are code points, end exclusive.  A null text has no spans; repeated rows give repeated results; other columns of the input
stay as they are.  Texts are taken whole.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds in the order in which spans with equal start are listed.
KINDS = ("assign", "access", "hex", "signed_token", "private_key", "public_key", "ssh_key")
BASE = KINDS[:3]

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Any assignment holds one of these in lower case.
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Texts without such a run hold no line of base64.
LONG = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40}")
#: A character of base64 with either alphabet; five dashes begin or end a key's frame.
CHAR = r"(?:[A-Za-z0-9+/_]|-(?!----(?!-)))"
#: A line of base64, also behind a frame or an escaped break, and a further one behind breaks, escaped breaks and blanks.
ENCODED = re.compile(r"(?:(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nrt])|(?<=-----)|(?<=\\[nrt]))" + CHAR + "{40,}+={0,2}")
FURTHER = re.compile(r"(?:[ \t\r\n]|\\[nrt])++(?!-----)(" + CHAR + "++)={0,2}")
BETWEEN = re.compile(r"[ \t\r\n=]|\\[nrt]")
HEX_BLOB = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{64,}")
#: A JSON object encodes to ey.. or, with white space after the brace, ew..
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
#: Algorithm names of signed tokens.
ALGORITHMS = {"none", "HS256", "HS384", "HS512", "RS256", "RS384", "RS512", "ES256", "ES256K", "ES384", "ES512", "PS256", "PS384",
              "PS512", "EdDSA"}


def unbase64(s: str) -> bytes | None:
    """Bytes of a base64 string of either alphabet, with or without padding; None if it is none."""
    s = BETWEEN.sub("", s).replace("-", "+").replace("_", "/")
    if len(s) % 4 == 1:
        return None
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except binascii.Error:
        return None


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER values that fill data[start:end] exactly; None if lengths don't add up."""
    out = []
    while start < end:
        if start + 2 > end:
            return None
        tag, size = data[start], data[start + 1]
        start += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or start + n > end:
                return None
            size = int.from_bytes(data[start:start + n], "big")
            start += n
            if size < 0x80:  # DER takes the shortest form
                return None
        if start + size > end:
            return None
        out.append((tag, start, start + size))
        start += size
    return out


def der_key(data: bytes) -> str | None:
    """private_key or public_key if data is one DER sequence with the fields of such a key."""
    top = der_items(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return None
    items = der_items(data, *top[0][1:])
    if not items:
        return None
    tags = [t for t, _, _ in items]
    inner = {i: der_items(data, a, b) for i, (t, a, b) in enumerate(items) if t == 0x30}
    if any(v is None for v in inner.values()):
        return None
    version = data[items[0][1]:items[0][2]] if tags[0] == 2 else None
    names = lambda i: bool(inner.get(i)) and inner[i][0][0] == 6  # noqa: E731  an algorithm begins with an object identifier
    if version in (b"\0", b"\1") and len(tags) >= 3 and tags[1:3] == [0x30, 4] and names(1):
        return "private_key"  # PKCS #8
    if version in (b"\0", b"\1") and tags[:9] == [2] * 9:
        return "private_key"  # RSA: version, modulus, exponents, primes, coefficient
    if version == b"\0" and tags == [2] * 6:
        return "private_key"  # DSA
    if version == b"\1" and tags[1:2] == [4] and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return "private_key"  # elliptic curve
    if tags == [0x30, 3] and names(0):
        return "public_key"
    return None


OPENSSH = b"openssh-key-v1\0"


def ssh_field(data: bytes, at: int) -> int | None:
    """Where the length-prefixed field at this place ends; None if that is beyond the data."""
    end = at + 4 + int.from_bytes(data[at:at + 4], "big")
    return end if end <= len(data) else None


def ssh_private_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key that data begins with: three names, the number of keys, their public parts, the private part."""
    at: int | None = len(OPENSSH)
    for _ in range(3):
        if (at := ssh_field(data, at)) is None:
            return None
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    for _ in range(keys + 1 if keys else 0):
        if (at := ssh_field(data, at)) is None:
            return None
    return at if keys else None


def ssh_key(data: bytes) -> bool:
    """An OpenSSH private key, or a public blob; length-prefixed fields fill it exactly."""
    if data.startswith(OPENSSH):
        return ssh_private_size(data) == len(data)
    at, fields = 0, []
    while at < len(data):
        end = ssh_field(data, at)
        if end is None:
            return False
        fields.append(data[at + 4:end])
        at = end
    return len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk-ssh)-[a-z0-9-]+(@openssh\.com)?", fields[0]) is not None


def token_header(s: str) -> bool:
    """The first part of a signed token decodes to a JSON object that names an algorithm."""
    data = unbase64(s)
    try:
        header = json.loads(data) if data and data[:1] == b"{" else None
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and header.get("alg") in ALGORITHMS


def kind_of(data: bytes | None) -> str | None:
    if not data:
        return None
    if data[0] == 0x30 and (kind := der_key(data)):
        return kind
    return "ssh_key" if data[:3] in (b"ope", b"\0\0\0") and ssh_key(data) else None


class Run:
    """Lines of base64 that follow each other, walked once for all keys that may begin in them.

    chars: their characters without what lies between; cum: how many of them come before each line, and in all.
    """

    def __init__(self, text: str, start: int, end: int):
        parts = [text[start:end].rstrip("=")]
        self.starts, self.ends = [start], [end]
        while text[end - 1] != "=" and (m := FURTHER.match(text, end)):
            end = m.end()
            parts.append(m[1])
            self.starts.append(m.start(1))
            self.ends.append(end)
        self.chars = "".join(parts)
        self.cum = [0, *accumulate(map(len, parts))]
        #: Place behind the last line at which a field of a public blob ends, by where the fields are read from.
        self.public: dict[tuple[int, int], int | None] = {}

    def line(self, start: int) -> int | None:
        """Number of the line that begins at a place of the text."""
        i = bisect_left(self.starts, start)
        return i if i < len(self.starts) and self.starts[i] == start else None

    def end_of(self, i: int, n: int) -> int | None:
        """Where n characters from line i on end, if a line ends there."""
        j = bisect_left(self.cum, self.cum[i] + n, i + 1)
        return self.ends[j - 1] if j < len(self.cum) and self.cum[j] == self.cum[i] + n else None


class Decoded:
    """Bytes of a run from one of its lines on, decoded where they are read."""

    def __init__(self, run: Run, i: int):
        self.chars, self.first = run.chars, run.cum[i]
        n = len(self.chars) - self.first
        self.size = (n - (n % 4 == 1)) * 3 // 4

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, part: slice) -> bytes:
        a, b = part.start, min(part.stop, self.size)
        if a >= b:
            return b""
        begin = a // 3 * 4
        return unbase64(self.chars[self.first + begin:min(len(self.chars), self.first - (-b // 3) * 4)])[a % 3:][:b - a]


def public_end(run: Run, i: int) -> int | None:
    """Where the public blob ends that begins with line i: the last line end at which two or more of its fields end, too."""
    data, phase = Decoded(run, i), run.cum[i] % 4
    base = run.cum[i] // 4 * 3  # so that lines of one phase name a byte alike
    at, path = ssh_field(data, 0), []
    while at is not None and at < len(data) and (phase, base + at) not in run.public:
        path.append(at)
        at = ssh_field(data, at)
    best = run.public.get((phase, base + at)) if at is not None and at < len(data) else None
    if path and at is not None and at >= len(data):
        best = None
    # each step's end is the next one's beginning; the last ends that are line ends come first
    for here, stop in zip(reversed(path), [at, *reversed(path[1:])]):
        if best is None and stop is not None:
            n = -(-stop * 4 // 3)
            best = run.end_of(i, n) if n % 4 != 1 and n * 3 // 4 == stop else None
        run.public[phase, base + here] = best
    return best


def encoded_key(text: str, start: int, end: int, run: Run | None = None) -> tuple[str, int] | None:
    """Kind and end of the key whose base64 begins with the line text[start:end].

    The lengths that the key states tell which of the lines after the first are its own.
    """
    head = unbase64(text[start:start + 40])
    der = head[0] == 0x30
    if not (der or OPENSSH.startswith(head[:len(OPENSSH)]) or head[:3] == b"\0\0\0" and head[4:].startswith((b"ssh-", b"ecdsa-", b"sk-ssh-"))):
        return None
    if run is None or (i := run.line(start)) is None:
        run, i = Run(text, start, end), 0
    stop: int | None = end
    if der or OPENSSH.startswith(head[:len(OPENSSH)]):
        if der:
            n = head[1] & 0x7F if head[1] & 0x80 else 0
            size = 2 + n + (int.from_bytes(head[2:2 + n], "big") if n else head[1]) if n <= 4 else None
        else:
            size = ssh_private_size(Decoded(run, i))
        stop = run.end_of(i, -(-size * 4 // 3)) if size else None
    elif not kind_of(unbase64(text[start:end])):
        stop = public_end(run, i)
    kind = kind_of(unbase64(text[start:stop])) if stop else None
    return (kind, stop) if kind else None


def base_spans(text: str) -> list[tuple[int, str, int]]:
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    found = []
    for m in HEX_BLOB.finditer(text):
        if len(m[0]) % 2 == 0 and (kind := kind_of(bytes.fromhex(m[0]))):
            found.append((m.start(), kind, m.end()))
    at = 0 if LONG.search(text) else len(text)
    run: Run | None = None
    while m := ENCODED.search(text, at):
        if run is None or run.line(m.start()) is None:
            run = Run(text, *m.span())
        key = encoded_key(text, *m.span(), run)
        if key:
            found.append((m.start(), *key))
        at = key[1] if key else m.end()
    for m in SIGNED.finditer(text):
        if token_header(m[0].split(".", 1)[0]):
            found.append((m.start(), "signed_token", m.end()))
    return found


def spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of one text, by start, then by kind as listed."""
    if not text:
        return []
    return sorted({*base_spans(text), *confirmed_spans(text)}, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


SPANS = "array<struct<start:int,kind:string,end:int>>"


def secret_spans(text: Column) -> Column:
    """All secrets of a text: array of (start, kind, end)."""

    @F.pandas_udf(SPANS)
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([[{"start": a, "kind": k, "end": b} for a, k, b in spans(t)] for t in texts], dtype=object)

    return scan.asNondeterministic()(text)


def listed(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(found: Column, *kinds: str) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))
