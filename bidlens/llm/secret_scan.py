"""Secret scan with structural confirmation.

Plain patterns find assignments, access key ids and long hex runs. Beyond them,
candidates are decoded and reported only when their structure holds: a signed token
whose header names an algorithm and whose payload is an object, an encrypted token whose
header names both ciphers and whose parts have those's lengths, base64 or hex that
decodes to a DER key (every nested length fits its parent, and the fields are those
of a PKCS#1, PKCS#8, encrypted PKCS#8, EC or DSA private key), an OpenSSH key container with
all its length-prefixed fields, a PEM block around either or around whole cipher blocks under
a header that names the cipher and a vector of its size, an armoured OpenPGP block whose packets
fill it and begin with a secret key, a JSON key object with the private members of its type, and
base64 whose decoded text holds one of these.

Line breaks may be escaped as in JSON or source strings. Keys broken into lines, the first
of at least 16 characters, are joined: the length a key states tells where it ends, and that
must be the end of a line. Lines of one width are also joined for base64 of text. Lines may
be indented, quoted or commented. A line that holds a secret of its own is reported too.

One linear-time pattern over each Arrow batch picks the texts that can hold anything;
only those are looked at in Python. Nothing is shuffled.

Defined cases: a null text is empty and has no spans; spans of different kinds may
overlap; repeated rows are scanned alike; positions count code points, ends exclusive;
extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.ship import shipped

BASE_KINDS = ("assign", "access", "hex")
CONFIRMED_KINDS = ("jwt", "pem", "der", "ssh", "wrapped", "jwe", "pgp", "jwk")
KIND_ORDER = {k: i for i, k in enumerate(BASE_KINDS + CONFIRMED_KINDS)}
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(e[yw][A-Za-z0-9_-]{6,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"""-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s:,.;\\"'`>#*|_]++|-(?!----))*+)-----END \1-----""")
ENCRYPTED = re.compile(r"(?<![A-Za-z0-9_-])e[yw][A-Za-z0-9_-]{6,}+\.[A-Za-z0-9_-]*+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++(?!\.[A-Za-z0-9_-])")
CIPHER = re.compile(r"DEK-Info:[ ]?(AES|CAMELLIA|ARIA|SEED|DES|RC2|IDEA|BF|CAST5)[A-Z0-9-]*,([0-9A-Fa-f]+)")
WIDE_BLOCKS = ("AES", "CAMELLIA", "ARIA", "SEED")  # ciphers of 16 bytes a block, the others have 8
PGP = re.compile(r"""-----BEGIN PGP PRIVATE KEY BLOCK-----((?:[A-Za-z0-9+/=\s:,.;\\"'`>#*|_()@<]++|-(?!----))*+)-----END PGP PRIVATE KEY BLOCK-----""")
PGP_SUM = re.compile(r"=([A-Za-z0-9+/]{4})$")
OBJECT = re.compile(r"\{[^{}]*+\}")
KEY_TYPE = re.compile(r"""kty\\*+["']""")
# Private members of key objects, and bytes of a private number by curve.
JWK_MEMBERS = {"RSA": ("n", "e", "d"), "EC": ("crv", "x", "y", "d"), "OKP": ("crv", "x", "d"), "oct": ("k",)}
CURVE_BYTES = {"P-256": 32, "P-384": 48, "P-521": 66, "secp256k1": 32, "Ed25519": 32, "X25519": 32, "Ed448": 57, "X448": 56}
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
ESCAPED_BREAK = re.compile(r"\\(?:[nrt]|u000[9aAdD]|x0[9aAdD])|&#(?:10|13|x[aAdD]);")
ESCAPED_CHARACTER = re.compile(r"\\(?:/|u00(?:2[bBfF]|3[dD]))")
LINE = r"(?:[A-Za-z0-9+/_-]++|\\(?:/|u002[bBfF]))++(?:=|\\u003[dD]){0,2}+"
BREAK = r"""(?:(?:[ \t\r"'`.,;\\]|(?<=[ \t"'`])\+)*+\n)++(?:[ \t\r"'`>#*|,]|(?<=[ \t"'`])\+(?=[ \t"'`]))*+"""
BREAKS = re.compile(BREAK)
LINES = re.compile(rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_\\-]{{16}}){LINE}(?:{BREAK}{LINE})*+")
# Whatever the patterns above can match contains a match of this.
MAYBE = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|[0-9A-Fa-f]{64}|e[yw][A-Za-z0-9_-]{6}|PRIVATE KEY(?: BLOCK)?-----" \
    r"""|kty\\*["']|[A-Za-z0-9+/_\\-]{40}|[A-Za-z0-9+/_\\-]{16}={0,2}[ \t\r"'`.,;\\+]*(?:\n|\\|&#)"""
OPENSSH = b"openssh-key-v1\0"
OPENSSH_64 = base64.b64encode(OPENSSH).decode()
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long")


class Span(NamedTuple):
    start: int
    kind: str
    end: int


def base_spans(text: str) -> list[Span]:
    """Spans of the plain patterns; a match too short uses its characters up but is left out."""
    found = [Span(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [Span(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [Span(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]


def unbase64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def unhex(run: str) -> bytes:
    try:
        return bytes.fromhex(run)
    except ValueError:
        return b""


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of consecutive DER items that fill ``data`` exactly, else None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
            if size < 0x80:
                return None  # DER has one form of a length
        if at + size > len(data):
            return None
        items.append((tag, data[at:at + size]))
        at += size
    return items


SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one private key in DER."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    items = der_items(outer[0][1])
    if not items:
        return False
    tags = [tag for tag, _ in items]
    if tags[:1] == [INTEGER] and items[0][1] in (b"\0", b"\1"):
        if tags[:9] == [INTEGER] * 9:  # PKCS#1
            return True
        if tags == [INTEGER] * 6:  # DSA
            return items[0][1] == b"\0"
        if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # PKCS#8
            inner = der_items(items[1][1])
            return bool(inner) and inner[0][0] == OID and bool(der_items(items[2][1]))
        return tags[:2] == [INTEGER, OCTETS] and items[0][1] == b"\1" and len(items[1][1]) >= 16 and all(
            tag in (0xA0, 0xA1) for tag in tags[2:])  # EC
    if tags == [SEQUENCE, OCTETS]:  # encrypted PKCS#8
        inner = der_items(items[0][1])
        return bool(inner) and inner[0][0] == OID and len(inner) == 2
    return False


def der_size(head: bytes) -> int:
    """Bytes of the DER sequence that starts with these, as far as its length says; 0 if there is none."""
    if len(head) < 2 or head[0] != SEQUENCE:
        return 0
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    return 2 + n + int.from_bytes(head[2:2 + n], "big") if n else 2 + head[1]


def openssh_size(read: Callable[[int, int], bytes]) -> int:
    """Bytes that cipher, kdf, options, key count, public keys and private block of a container take; 0 if it is none.

    ``read`` gives bytes by place and number, so only the fields' lengths are decoded.
    """
    if read(0, len(OPENSSH)) != OPENSSH:
        return 0
    at = len(OPENSSH)

    def number() -> int:
        nonlocal at
        at += 4
        return int.from_bytes(read(at - 4, 4), "big")

    for _ in range(3):
        size = number()
        at += size
    keys = number()
    if not 1 <= keys <= 64:
        return 0
    for _ in range(keys + 1):
        size = number()
        at += size
    return at


def base64_reader(body: str, start: int) -> Callable[[int, int], bytes]:
    """Bytes by place and number of the base64 that begins at ``start``, decoded where they are."""
    def read(at: int, n: int) -> bytes:
        first, stop = start + at // 3 * 4, start - -(at + n) // 3 * 4
        run = body[first:stop].split("=", 1)[0]
        return (unbase64(run[:len(run) - (len(run) % 4 == 1)]) or b"")[at % 3:at % 3 + n]

    return read


def is_openssh_key(data: bytes) -> bool:
    """Whether the fields fill the container exactly."""
    return 0 < openssh_size(lambda at, n: data[at:at + n]) == len(data)


def is_encrypted_token(token: str) -> bool:
    """Whether five parts are a header naming both ciphers, a wrapped key, a vector, a text and a mark of proper sizes."""
    header, key, vector, text, mark = token.split(".")
    try:
        head = json.loads(unbase64(header) or b"")
    except (ValueError, RecursionError):
        return False
    parts = [unbase64(p) for p in (key, vector, text, mark)]
    return (isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(head.get("enc"), str)
            and None not in parts and len(parts[1]) in (12, 16) and len(parts[2]) > 0 and len(parts[3]) in (16, 24, 32))


def is_cipher_body(block: str, data: bytes) -> bool:
    """Whether a PEM block names a cipher with a vector of its block size and holds whole blocks, three or more."""
    found = CIPHER.search(block)
    if not found:
        return False
    size = 16 if found[1] in WIDE_BLOCKS else 8
    return len(found[2]) == 2 * size and len(data) >= 48 and len(data) % size == 0


def crc24(data: bytes) -> int:
    total = 0xB704CE
    for byte in data:
        total ^= byte << 16
        for _ in range(8):
            total = total << 1 ^ (0x1864CFB if total & 0x800000 else 0)
    return total & 0xFFFFFF


def packet_tags(data: bytes) -> list[int]:
    """Tags of the OpenPGP packets that fill ``data`` exactly; none if they don't."""
    tags, at = [], 0
    while at < len(data):
        head, at = data[at], at + 1
        if not head & 0x80:
            return []
        if head & 0x40:
            tag, first = head & 0x3F, data[at] if at < len(data) else 0xE0
            if 0xE0 <= first < 0xFF:
                return []  # parts of unknown total length, which keys don't have
            n = 1 if first < 0xC0 else 2 if first < 0xE0 else 5
            size = {1: first, 2: (first - 0xC0 << 8) + int.from_bytes(data[at + 1:at + 2], "big") + 0xC0,
                    5: int.from_bytes(data[at + 1:at + 5], "big")}[n]
        else:
            tag, n = head >> 2 & 15, (1, 2, 4, 0)[head & 3]
            size = int.from_bytes(data[at:at + n], "big") if n else len(data) - at
        at += n + size
        tags.append(tag)
    return tags if at == len(data) else []


def is_pgp_key(body: str) -> bool:
    """Whether an armoured body is OpenPGP packets that begin with a secret key, under the checksum it states."""
    lines = without_escapes(BREAKS.sub("\n", with_breaks(body))).split("\n")
    joined = "".join(line.strip(" \t\r\"'`") for line in lines if ":" not in line)
    stated = PGP_SUM.search(joined)
    data = unbase64(joined[:stated.start()] if stated else joined)
    if not data or packet_tags(data)[:1] != [5]:
        return False
    return not stated or crc24(data).to_bytes(3, "big") == unbase64(stated[1])


def is_private_jwk(text: str) -> bool:
    """Whether a JSON object, maybe escaped, is a key of a known type with all members of its private form."""
    while True:
        try:
            key = json.loads(text)
            break
        except (ValueError, RecursionError):
            if '\\"' not in text:
                return False
            text = text.replace('\\"', '"').replace("\\\\", "\\")
    members = JWK_MEMBERS.get(key.get("kty") if isinstance(key.get("kty"), str) else "", ())
    if not members or not all(isinstance(key.get(m), str) and key[m] for m in members):
        return False
    raw = {m: unbase64(key[m]) for m in members if m != "crv"}
    if not all(raw.values()):
        return False
    if "crv" in members:
        return len(raw["d"]) == CURVE_BYTES.get(key["crv"])
    return len(raw["k"]) >= 16 if "k" in raw else 64 <= len(raw["n"]) and len(raw["d"]) <= len(raw["n"])


def is_signed_token(header: str, payload: str) -> bool:
    try:
        head, body = json.loads(unbase64(header) or b""), json.loads(unbase64(payload) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def with_breaks(text: str) -> str:
    """The text with escaped line breaks as line breaks, every character in its place."""
    return ESCAPED_BREAK.sub(lambda m: "\n".ljust(len(m[0])), text)


def without_escapes(run: str) -> str:
    return ESCAPED_CHARACTER.sub(lambda m: m[0][1:] if m[0][1] == "/" else chr(int(m[0][2:], 16)), run)


def holds_secret(data: bytes) -> bool:
    """Whether decoded base64 is text with an access key, a signed token or a key."""
    try:
        inner = data.decode("ascii")
    except UnicodeDecodeError:
        return False
    return bool(ACCESS.search(inner) and base_spans(inner) or confirmed_spans(inner, False))


def joined_spans(text: str, block: re.Match, nested: bool) -> Iterator[Span]:
    """Spans of keys, and of base64 of text, in consecutive lines."""
    starts, ends = [block.start()], []
    for m in BREAKS.finditer(text, *block.span()):
        ends.append(m.start())
        starts.append(m.end())
    ends.append(block.end())
    lines = [without_escapes(text[a:b]) for a, b in zip(starts, ends)]
    body, at = "".join(lines), [0, *accumulate(map(len, lines))]
    line_end = {a + len(line.rstrip("=")): end for a, line, end in zip(at, lines, ends)}
    for a, start in zip(at, starts):
        if body[a] == "M":  # a sequence's tag in base64
            stop = a - -4 * der_size(unbase64(body[a:a + 8].rstrip("=")) or b"") // 3
            if stop in line_end and is_der_key(unbase64(body[a:stop]) or b""):
                yield Span(start, "der", line_end[stop])
        elif body.startswith(OPENSSH_64, a):
            stop = a - -4 * openssh_size(base64_reader(body, a)) // 3
            if stop in line_end and is_openssh_key(unbase64(body[a:stop]) or b""):
                yield Span(start, "ssh", line_end[stop])
        elif body[a:a + 2] in ("30", "0x", "0X"):
            skip = 2 if body[a + 1] in "xX" else 0
            stop = a + skip + 2 * der_size(unhex(body[a + skip:a + skip + 12]))
            if stop in line_end and is_der_key(unhex(body[a + skip:stop])):
                yield Span(start + skip, "der", line_end[stop])
    first = 0
    while nested and first < len(lines):
        after = first + 1
        while after < len(lines) and len(lines[after]) == len(lines[first]):
            after += 1
        shorter = after < len(lines) and len(lines[after]) < len(lines[first])
        for stop in (after + 1, after) if shorter else (after,):
            data = unbase64(body[at[first]:at[stop]]) if at[stop] - at[first] >= 40 else None
            if data and holds_secret(data):
                yield Span(starts[first], "wrapped", ends[stop - 1])
                break
        first = after


def confirmed_spans(text: str, nested: bool = True) -> list[Span]:
    """Spans whose decoded structure is that of a key or a signed token."""
    broken = with_breaks(text) if "\\" in text or "&#" in text else text
    found = _confirmed(text, nested)
    return found if broken == text else list(set(found) | set(_confirmed(broken, nested)))


def _confirmed(text: str, nested: bool) -> list[Span]:
    found = [Span(m.start(), "jwt", m.end()) for m in SIGNED.finditer(text) if is_signed_token(m[1], m[2])]
    for m in PEM.finditer(text):
        lines = [x for x in m[2].split("\n") if ":" not in x]  # header lines of old encrypted blocks
        data = unbase64("".join(without_escapes(BREAKS.sub("\n", "\n".join(lines))).split()))
        if data and (is_der_key(data) or is_openssh_key(data) or is_cipher_body(m[2], data)):
            found.append(Span(m.start(), "pem", m.end()))
    found += [Span(m.start(), "pgp", m.end()) for m in PGP.finditer(text) if is_pgp_key(m[1])]
    found += [Span(m.start(), "jwe", m.end()) for m in ENCRYPTED.finditer(text) if is_encrypted_token(m[0])]
    if KEY_TYPE.search(text):
        found += [Span(m.start(), "jwk", m.end()) for m in OBJECT.finditer(text) if KEY_TYPE.search(m[0]) and is_private_jwk(m[0])]
    for m in BASE64_RUN.finditer(text):
        data = unbase64(m[0])
        if not data:
            continue
        if data[0] == SEQUENCE and is_der_key(data):
            found.append(Span(m.start(), "der", m.end()))
        elif data.startswith(OPENSSH) and is_openssh_key(data):
            found.append(Span(m.start(), "ssh", m.end()))
        elif nested and holds_secret(data):
            found.append(Span(m.start(), "wrapped", m.end()))
    for m in HEX_RUN.finditer(text):
        data = bytes.fromhex(m[0])
        if data[0] == SEQUENCE and is_der_key(data):
            found.append(Span(m.start(), "der", m.end()))
    known = set(found)
    for m in LINES.finditer(text):
        found += [s for s in joined_spans(text, m, nested) if s not in known]
    return found


def scan_text(text: str) -> list[Span]:
    """All spans of a text by start, then kind."""
    found = set(base_spans(text)) | set(confirmed_spans(text))
    return sorted(found, key=lambda s: (s.start, KIND_ORDER[s.kind], s.end))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def _scanned(texts: pa.Array) -> Iterator[tuple[int, str, list[Span]]]:
    """Row, text and spans of every text that has any."""
    maybe = pc.fill_null(pc.match_substring_regex(texts, MAYBE), False)
    for i in pc.indices_nonzero(maybe).to_pylist():
        text = texts[i].as_py()
        spans = scan_text(text)
        if spans:
            yield i, text, spans


def scan(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): counts and digest of the plain spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = batch.num_rows
            counts = {k: [0] * n for k in BASE_KINDS}
            digest, spans, confirmed = [nothing] * n, [""] * n, [0] * n
            for i, _, found in _scanned(batch.column(1)):
                base = [s for s in found if s.kind in BASE_KINDS]
                for s in base:
                    counts[s.kind][i] += 1
                digest[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                spans[i], confirmed[i] = joined(found), len(found) - len(base)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), **{f"n_{k}": pa.array(counts[k], pa.int64()) for k in BASE_KINDS},
                "base_sha256": digest, "spans": spans, "n_confirmed": pa.array(confirmed, pa.int64())})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return shipped(rows).mapInArrow(run, SCHEMA)


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with every run of overlapping spans replaced by a mark."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at:s.start], "[SECRET]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all secrets replaced in ``text``, and ``n_chars``, where there is one, counted anew for those texts."""
    names = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.columns))
            found = [(i, redact_text(text, spans)) for i, text, spans in _scanned(columns["text"])]
            if found:
                rows, texts = zip(*found)
                mask = [False] * batch.num_rows
                for i in rows:
                    mask[i] = True
                columns["text"] = pc.replace_with_mask(columns["text"], pa.array(mask), pa.array(texts, columns["text"].type))
                if "n_chars" in columns:
                    columns["n_chars"] = pc.replace_with_mask(columns["n_chars"], pa.array(mask), pa.array(
                        list(map(len, texts)), columns["n_chars"].type))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return shipped(docs).mapInArrow(run, schema)
