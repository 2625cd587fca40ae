"""Secrets: plain patterns plus candidates that are decoded and parsed before they are reported.

The base kinds (assign, access, hex) follow their patterns alone. The method adds
spans only where the decoded bytes have the structure of a credential:

* ``jwt``: three dotted base64url parts whose first decodes to a JSON object that names an algorithm, and a signature;
* ``key_der``: base64 or hex of a DER private key, plain or encrypted, every nested length consistent;
* ``key_ssh``: base64 of an OpenSSH private key, every length prefix consistent.

A key in base64 may be folded into lines, with indentation, or with line ends written as
escapes, and ends where its own head says, whatever base64 follows.

Defined cases: null and empty texts have no spans; repeated rows each get theirs; spans
that begin at one place (ties) are ordered by kind as listed; very long texts are scanned
whole; an empty table stays empty. A column that has the result's name is replaced, all
other columns stay as they are.
"""

from __future__ import annotations

import base64
import bisect
import json
import re

from pyspark.sql import DataFrame

from colsink.llm.common import read_table
from colsink.llm.spans import Span, digest, in_order, mask_udf, spans_udf

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "key_der", "key_ssh")

_NAMES = ("password", "passwd", "secret", "token", "api")
_ASSIGN = re.compile(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
# A shorter run fails at its start and, being shorter still, from within; so the least length can stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# e[wy] starts the base64 of an opening brace, with white space or a quotation mark behind it
_JWT = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
# base64 of a DER sequence's tag and length, or of the SSH format's first bytes, where a run of base64 begins or a
# line does, also one whose end is written as an escape
_KEY = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n)|(?<=\\r))(?:M[A-P][A-Za-z0-9+/]{10}|b3BlbnNzaC1rZXkt)")
# one line of base64, and what may stand between two: line ends, plain or escaped, and indentation
_LINE = re.compile(r"[A-Za-z0-9+/]++")
_FOLD = re.compile(r"(?:\\[rn]|[\r\n])+[ \t]*")
_PAD = re.compile(r"(?:(?:(?:\\[rn]|[\r\n])+[ \t]*)?=){1,2}")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{40,}+")
_SSH_MAGIC = b"openssh-key-v1\x00"


class Base64:
    """Bytes of a run of base64 that are decoded only where they are read."""

    def __init__(self, packed: str, at: int = 0):
        self.packed, self.at = packed, at
        self.size = (len(packed) - at) * 3 // 4

    def read(self, i: int, j: int) -> bytes:
        first, last = i // 3, -(-min(j, self.size) // 3)
        part = self.packed[self.at + 4 * first : self.at + 4 * last]
        part = part[: len(part) - (len(part) % 4 == 1)]
        return base64.b64decode(part + "=" * (-len(part) % 4))[i - 3 * first : j - 3 * first]


class Hex(Base64):
    """The same of a run of hexadecimal digits."""

    def __init__(self, packed: str):
        self.packed, self.size = packed, len(packed) // 2

    def read(self, i: int, j: int) -> bytes:
        return bytes.fromhex(self.packed[2 * i : 2 * min(j, self.size)])


Item = tuple[int, int, int]  # tag, where the content begins and ends


def der_item(data: Base64, at: int, end: int) -> Item | None:
    """The DER item at a place, if it fits before ``end``."""
    head = data.read(at, min(at + 6, end))
    width = head[1] & 0x7F if len(head) > 1 and head[1] >= 0x80 else 0
    if len(head) < 2 + width or head[1] == 0x80 or width > 4:
        return None
    start = at + 2 + width
    stop = start + (int.from_bytes(head[2 : 2 + width], "big") if width else head[1])
    return (head[0], start, stop) if stop <= end else None


def der_items(data: Base64, at: int, end: int, most: int = 10) -> list[Item] | None:
    """The DER items that fill a span exactly, if they are ``most`` at the utmost; no key has more."""
    out: list[Item] = []
    while at < end:
        item = der_item(data, at, end) if len(out) < most else None
        if item is None:
            return None
        out.append(item)
        at = item[2]
    return out


#: Object identifiers of password-based encryption begin with one of these (fixed values): PKCS#5 and PKCS#12.
_ENCRYPTED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def der_key_size(data: Base64) -> int | None:
    """Bytes of the private key that ``data`` begins with, by its nested items: PKCS#1, PKCS#8 (plain or
    encrypted), SEC1 or DSA. Its lengths alone are read, so a look costs the same whatever it declares."""
    outer = der_item(data, 0, data.size)
    inner = der_items(data, outer[1], outer[2]) if outer and outer[0] == 0x30 else None
    if not inner or len(inner) < 2:
        return None
    tags = [tag for tag, _, _ in inner]
    sizes = [stop - start for _, start, stop in inner]

    def algorithm(item: Item) -> bytes:
        name = der_item(data, item[1], item[2])
        return data.read(name[1], min(name[2], name[1] + 9)) if name and name[0] == 0x06 else b""

    if tags == [0x30, 0x04]:  # encrypted PKCS#8: algorithm, encrypted key
        good = sizes[1] >= 16 and algorithm(inner[0]).startswith(_ENCRYPTED)
    elif tags[0] != 0x02 or data.read(inner[0][1], inner[0][2]) not in (b"\x00", b"\x01"):
        good = False
    elif tags[:9] == [0x02] * 9:  # RSA: version, eight integers and perhaps more primes
        good = tags[9:] in ([], [0x30]) and sizes[1] >= 32
    elif tags == [0x02] * 6:  # DSA: version, three parameters, both keys
        good = sizes[1] >= 64
    elif tags[:3] == [0x02, 0x30, 0x04]:  # PKCS#8: version, algorithm, key
        good = bool(algorithm(inner[1]))
    else:
        good = tags[:2] == [0x02, 0x04] and sizes[1] in (28, 32, 48, 66)  # SEC1
    return outer[2] if good else None


def ssh_key_size(data: Base64) -> int | None:
    """Bytes of the OpenSSH private key that ``data`` begins with: magic, three strings, a count, then a string for
    each public key and one for the private ones. None where a length does not fit."""
    at = len(_SSH_MAGIC)
    if data.read(0, at) != _SSH_MAGIC:
        return None

    def word() -> int | None:
        nonlocal at
        at += 4
        return int.from_bytes(data.read(at - 4, at), "big") if at <= data.size else None

    def string() -> bool:
        nonlocal at
        size = word()
        at += size or 0
        return size is not None and at <= data.size

    if not all(string() for _ in range(3)):
        return None
    count = word()
    return at if count and count <= 64 and all(string() for _ in range(count + 1)) else None


def _run(text: str, start: int) -> tuple[str, list[int], list[int], int]:
    """A run of base64 across folds: its characters, where each line begins among them and in the text, and its end."""
    parts, among, places, at, got, end = [], [], [], start, 0, start
    while m := _LINE.match(text, at):
        parts.append(m[0])
        among.append(got)
        places.append(at)
        got, end = got + len(m[0]), m.end()
        fold = _FOLD.match(text, end)
        if not fold:
            break
        at = fold.end()
    return "".join(parts), among, places, end


def _keys(text: str) -> list[Span]:
    """Private keys in base64, each cut at the size that its own head declares; a run is unfolded once."""
    found: list[Span] = []
    run, until, done = None, -1, -1
    for m in _KEY.finditer(text):
        start = m.start()
        if start < done:
            continue
        if start >= until:
            run = _run(text, start)
            until = run[3]
        packed, among, places, _ = run
        line = bisect.bisect_right(places, start) - 1
        at = among[line] + start - places[line]
        data = Base64(packed, at)
        kind, size = ("key_ssh", ssh_key_size(data)) if m[0][0] == "b" else ("key_der", der_key_size(data))
        if size is None:
            continue
        last = at - (-size * 4 // 3)  # characters that hold ``size`` bytes
        line = bisect.bisect_left(among, last) - 1
        end = places[line] + last - among[line]
        pad = _PAD.match(text, end)
        done = pad.end() if pad else end
        found.append((kind, start, done, 1.0, False))
    return found


def is_signed_token(token: str) -> bool:
    """The header of a dotted token is a JSON object that names an algorithm, and there is a signature.

    The algorithm ``none`` stands for an unsigned token, which is no secret.
    """
    head, _, rest = token.partition(".")
    if len(head) % 4 == 1 or not rest.rpartition(".")[2]:
        return False
    try:
        header = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and header["alg"].lower() not in ("", "none")


def find_secrets(text: str) -> list[Span]:
    """All spans of a text, by start and then kind."""
    found: list[Span] = []
    small = text.lower()
    if any(n in small for n in _NAMES):
        found += [("assign", *m.span(), 0.6, True) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span(), 0.9, True) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span(), 0.4, True) for m in _HEX.finditer(text)]
    if "ey" in text or "ew" in text:
        found += [("jwt", *m.span(), 1.0, False) for m in _JWT.finditer(text) if is_signed_token(m[0])]
    if len(text) >= 40:
        found += _keys(text)
        for m in _HEX_KEY.finditer(text):
            size = der_key_size(Hex(m[0]))
            if size is not None:
                found.append(("key_der", m.start(), m.start() + 2 * size, 1.0, False))
    return in_order(found, KINDS)


secret_spans = spans_udf(find_secrets)
mask_secrets = mask_udf(find_secrets)


def with_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """Each row with its spans; null and empty texts have none, repeated rows each get theirs."""
    return docs.withColumn(into, secret_spans(docs[text].cast("string")))


def op8_parsed_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of ``documents`` (null: empty)."""
    docs = with_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    return docs.select("doc_id", *[c.alias(n) for n, c in digest(docs["secrets"], BASE_KINDS).items()])
