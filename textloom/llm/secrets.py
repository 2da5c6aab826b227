"""Operator 2, secret scans by structural confirmation.

Base kinds are patterns (assign, access, hex). On top of them, base64 and hex candidates are decoded and reported only if
their structure holds: key encodings by their nested DER lengths, OpenSSH keys by their nested length prefixes, signed and
encrypted tokens by their header, and wrapped secrets by what is found in the decoded text, up to `DEPTH` encodings deep. Line
ends within an encoding may be real or escaped as in JSON; keys may follow a separator or be followed by other text, as each
declares its own length. PEM blocks with encryption headers count by those headers, as their bodies have no structure.

Kinds, in the order that breaks ties of start: assign, access, hex, jwt, pem, der, openssh, nested.

Scale: one pass, no shuffle. Each Arrow batch is searched for triggers with numpy and byte search, and only texts with a
trigger are matched in full; a trigger is a necessary condition of every kind, so nothing is lost.

Defined cases: null and empty texts have no span; a null doc_id stays null; repeated rows each give a row; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import table

KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "openssh", "nested")
RANK = {k: i for i, k in enumerate(KINDS)}
Span = tuple[int, str, int]

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f][0-9a-f]{23,}")
#: Three parts, or five of an encrypted token, whose second may be empty.
JWT = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*\.[A-Za-z0-9_-]*(?:\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)?")
ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
#: A line end, as it is or as JSON writes it (once or twice escaped), with the next line's indent.
LINE_END = r"(?:\r?\n|(?:\\{1,2}r)?\\{1,2}n)[ \t]*"
BLOB = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
HEX_RUN = re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")
#: Lines of base64 that make one value.
LINES = re.compile(rf"[A-Za-z0-9+/]{{40,}}+(?:{LINE_END}[A-Za-z0-9+/]+)+={{0,2}}")
#: Where base64 of a DER sequence or of an OpenSSH key may begin (fixed values: the first bits of their first bytes).
DER_AT, OPENSSH_AT = re.compile(r"M(?=[A-P][A-Za-z0-9+/_-]{6})"), "b3BlbnNzaC1rZXktdjEA"
#: Characters after which no encoding begins.
INNER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+")
RUN_OF, PADDING = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile("={0,2}")
BREAK = re.compile(LINE_END)
#: How often an encoding may lie within another.
DEPTH = 4
#: Lower-case words of which an assignment has one.
KEYWORDS = (b"passw", b"secret", b"token", b"api_key", b"apikey")
#: Characters of hex, base64 and both forms of base64url: a long run of them is a candidate.
RUN = np.zeros(256, bool)
RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
STEP = 24
#: Which characters base64 of plain ASCII text has at each of the four places of a group.
_B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PLACES = np.zeros((4, 256), bool)
for _a in [9, 10, 13, *range(32, 127)]:
    PLACES[0, ord(_B64[_a >> 2])] = True
    for _v in range(4):
        PLACES[1, ord(_B64[_v << 4 | _a >> 4])] = True
    for _v in range(16):
        PLACES[2, ord(_B64[_v << 2 | _a >> 6])] = True
PLACES[3] = RUN


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds: leftmost, non-overlapping for each kind, failing matches dropped."""
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


def decode_base64(blob: str) -> bytes | None:
    """Bytes of base64 or base64url, padded or not; None if the form is broken."""
    body = blob.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_parts(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """(tag, content) of consecutive DER values that fill data exactly, else None; constructed values are checked within."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n & 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > len(data):
                return None
            n, at = int.from_bytes(data[at : at + size], "big"), at + size
        if at + n > len(data):
            return None
        content, at = data[at : at + n], at + n
        if tag & 0x20 and (depth > 16 or der_parts(content, depth + 1) is None):
            return None
        out.append((tag, content))
    return out


def is_key_der(data: bytes) -> bool:
    """PKCS#1, DSA, SEC1 or (encrypted) PKCS#8 private key: nested lengths and the leading fields must fit."""
    if data[:1] != b"\x30" or (top := der_parts(data)) is None or len(top) != 1 or not (parts := der_parts(top[0][1])):
        return False
    tags = [t for t, _ in parts]
    if tags[0] == 0x02:
        version = int.from_bytes(parts[0][1], "big") if len(parts[0][1]) == 1 else -1
        if len(parts) >= 6 and version in (0, 1) and all(t == 0x02 for t in tags[:6]):
            return True  # PKCS#1 has nine integers, DSA six
        if version in (0, 1) and tags[1:3] == [0x30, 0x04] and (der_parts(parts[1][1]) or [(0, b"")])[0][0] == 0x06:
            return True  # PKCS#8
        return version == 1 and len(tags) > 1 and tags[1] == 0x04 and 16 <= len(parts[1][1]) <= 72  # SEC1
    if tags == [0x30, 0x04]:  # encrypted PKCS#8
        inner = der_parts(parts[0][1])
        return bool(inner) and inner[0][0] == 0x06 and len(parts[1][1]) >= 32
    return False


def openssh_end(data: bytes) -> int | None:
    """Length of the openssh-key-v1 value that begins data: cipher, kdf, kdf options, count, then that many public blobs and one
    private one, all length-prefixed; None if there is none."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return None
    at = len(magic)

    def string() -> bool:
        nonlocal at
        if at + 4 > len(data) or at + 4 + (n := int.from_bytes(data[at : at + 4], "big")) > len(data):
            return False
        at += 4 + n
        return True

    if not (string() and string() and string()) or at + 4 > len(data):
        return None
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    return at if 1 <= count <= 16 and all(string() for _ in range(count + 1)) else None


def is_openssh(data: bytes) -> bool:
    return openssh_end(data) == len(data)


def token_end(token: str) -> int | None:
    """Length of the signed or encrypted token that begins token, of three or five base64url parts; None if its header is none.

    The header is a JSON object that names an algorithm; the payload is a JSON object, or it is encrypted and has five parts."""
    parts = token.split(".")
    try:
        header = json.loads(decode_base64(parts[0]) or b"")
        if not isinstance(header, dict) or not isinstance(header.get("alg"), str):
            return None
        if "enc" in header:
            return len(token) if len(parts) == 5 else None
        return len(".".join(parts[:3])) if isinstance(json.loads(decode_base64(parts[1]) or b""), dict) else None
    except (ValueError, RecursionError):
        return None


def printable(data: bytes) -> int:
    """How many bytes data begins with that are plain ASCII text."""
    m = re.match(rb"[\x20-\x7e\t\n\r]*", data)
    return m.end()


def holds_secret(text: str, depth: int) -> bool:
    """Whether decoded text has a secret of any kind but hex."""
    return any(k != "hex" for _, k, _ in base_spans(text)) or bool(depth < DEPTH and method_spans(text, depth + 1))


def confirmed(data: bytes, depth: int = 0) -> tuple[str, int] | None:
    """(kind, length) of what decoded bytes begin with, where that proves to be a secret."""
    if data[:1] == b"\x30" and (n := der_length(data)) and n <= len(data) and is_key_der(data[:n]):
        return "der", n
    if n := openssh_end(data):
        return "openssh", n
    n = printable(data)
    return ("nested", n) if n >= 12 and holds_secret(data[:n].decode(), depth) else None


def der_length(data: bytes) -> int | None:
    """Declared length of the DER value that begins data, header included; None if the header is none."""
    if len(data) < 6:
        return None
    if data[1] < 0x80:
        return 2 + data[1]
    size = data[1] & 0x7F
    return 2 + size + int.from_bytes(data[2 : 2 + size], "big") if 1 <= size <= 4 else None


def joined_body(text: str, start: int, chars: int) -> tuple[str, list[int]]:
    """Up to chars base64 characters from start, over line ends, and where each run of them ends: (characters so far, place)."""
    out, have, ends, at = [], 0, [], start
    while have < chars:
        m = RUN_OF.match(text, at, at + chars - have)
        if not m:
            break
        out.append(m[0])
        have += len(m[0])
        ends.append((have, m.end()))
        gap = BREAK.match(text, m.end())
        if not gap:
            break
        at = gap.end()
    return "".join(out), ends


def place_of(chars: int, ends: list[tuple[int, int]]) -> int:
    """Where the first chars characters of a joined body end in the text."""
    return next(place - (have - chars) for have, place in ends if have >= chars)


def unarmoured(text: str) -> list[Span]:
    """Key encodings in base64 without armour: each declares its own length, so what follows it does not matter."""
    out, done = [], 0
    starts = [(m.start(), None) for m in DER_AT.finditer(text) if m.start() == 0 or text[m.start() - 1] not in INNER]
    at = text.find(OPENSSH_AT)
    while at >= 0:
        starts.append((at, "openssh"))
        at = text.find(OPENSSH_AT, at + 1)
    for start, kind in sorted(starts):
        if start < done:
            continue
        if kind is None:
            n = der_length(decode_base64(text[start : start + 8]) or b"")
            if n is None or n < 32:
                continue
            chars = -(-n * 4 // 3)
        else:
            chars = 1 << 20
        body, ends = joined_body(text, start, chars)
        if kind is None and len(body) < chars:
            continue
        data = decode_base64(body if len(body) % 4 != 1 else body[:-1]) or b""
        found = confirmed(data) if kind or data[:1] == b"\x30" else None
        if found and found[0] in ("der", "openssh"):
            done = place_of(-(-found[1] * 4 // 3), ends)
            done += len(PADDING.match(text, done)[0])
            out.append((start, found[0], done))
    return out


def armoured(text: str) -> list[Span]:
    """PEM blocks: the nearest pair of a begin and an end of one label, whose body proves to be a key."""
    out, begin = [], None
    for m in ARMOUR.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin is not None and begin[2] == m[2]:
            if is_pem_body(BREAK.sub("\n", text[begin.end() : m.start()])):
                out.append((begin.start(), "pem", m.end()))
            begin = None
    return out


def is_pem_body(body: str) -> bool:
    """A body with its line ends restored: base64 of a key, or headers that say how it is encrypted, a blank line and base64."""
    head, blank, rest = body.lstrip().partition("\n\n")
    if blank and ":" in head:  # an encrypted body has no structure before decryption
        data = decode_base64("".join(rest.split()))
        return data is not None and len(data) >= 32 and "ENCRYPTED" in head and re.search(r"DEK-Info: *[A-Z0-9-]+,[0-9A-Fa-f]+", head) is not None
    data = decode_base64("".join(body.split()))
    return data is not None and (is_key_der(data) or is_openssh(data))


def nested_in(blob: str, depth: int) -> tuple[int, int] | None:
    """(start, end) of base64 within a run of its characters whose plain text holds a secret: the run, or what follows a separator."""
    for m in re.finditer(r"(?:^|[/_+=-])(?=[A-Za-z0-9+/_-]{16})", blob):
        start = m.end()
        head = decode_base64(blob[start : start + 16])
        if head is None or printable(head) < 12:
            continue
        body = blob[start:].rstrip("=")
        data = decode_base64(body if len(body) % 4 != 1 else body[:-1])
        if data and (found := confirmed(data, depth)) and found[0] == "nested":
            return start, min(len(blob), start + -(-found[1] * 4 // 3) + len(blob) - len(blob.rstrip("=")))
    return None


def method_spans(text: str, depth: int = 0) -> list[Span]:
    """Spans that structural confirmation adds."""
    out: list[Span] = armoured(text) if "-----BEGIN" in text else []
    if "eyJ" in text:
        out += [(m.start(), "jwt", m.start() + n) for m in JWT.finditer(text) if (n := token_end(m[0]))]
    within = bytearray(len(text) + 1)

    def cover(spans: list[Span]) -> None:
        for a, _, b in spans:
            within[a:b] = b"\1" * (b - a)

    cover(out)
    cover(more := [x for x in unarmoured(text) if not within[x[0]]])
    out += more
    blobs = list(BLOB.finditer(text))
    for blob in blobs:
        at = blob.start() + max(blob[0].rfind("-"), blob[0].rfind("_")) + 1
        m = LINES.match(text, at) if blob.end() - at >= 40 else None
        if m is None:
            continue
        lines = BREAK.split(m[0])
        width = len(lines[1]) if len(lines) > 2 else len(lines[0])
        if within[m.start()] or len(lines[1]) > width or len(lines[0]) < width:
            continue
        same = next((k for k in range(1, len(lines)) if len(lines[k]) != width), len(lines))
        whole = lines[: same + 1] if same < len(lines) and len(lines[same].rstrip("=")) < width else lines[:same]
        if found := nested_in("".join(whole), depth):
            _, ends = joined_body(text, m.start(), found[1])
            start, stop = place_of(found[0], [(0, m.start()), *ends]), place_of(min(found[1], ends[-1][0]), ends)
            out.append((start, "nested", stop + len(PADDING.match(text, stop)[0])))
            cover(out[-1:])
    for blob in blobs:
        for m in HEX_RUN.finditer(blob[0]) if blob.end() - blob.start() >= 32 else ():
            at, run = blob.start() + m.start(), m[0][: len(m[0]) // 2 * 2]
            if not within[at] and (found := confirmed(bytes.fromhex(run), depth)):
                out.append((at, found[0], at + 2 * found[1]))
                cover(out[-1:])
    for m in blobs:
        if not within[m.start()] and (found := nested_in(m[0], depth)) and not within[m.start() + found[0]]:
            out.append((m.start() + found[0], "nested", m.start() + found[1]))
    return out


def order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], RANK[s[1]], s[2]))


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind; offsets are code points, ends exclusive."""
    base = base_spans(text)
    return order(base), order(base + method_spans(text))


def suspects(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Numbers of the texts in a batch's bytes (text i begins at starts[i]) that have a trigger of any kind."""
    raw = data.tobytes()
    low, at = raw.lower(), []
    for held, words in ((low, KEYWORDS), (raw, (b"AKIA", b"-----BEGIN", b"eyJ"))):
        for w in words:
            p = held.find(w)
            while p >= 0:
                at.append(p)
                p = held.find(w, p + 1)
    # a run of 24 characters covers a position in every 24, and at least 12 of it lie on one side of that
    is_run, n = RUN[data], len(data)
    pos = np.arange(STEP - 1, n, STEP)
    pos = pos[is_run[pos]]
    reach = STEP // 2 - 1
    for sign in (-1, 1):
        p = pos[(pos >= reach) if sign < 0 else (pos + reach < n)]
        for k in (reach, *range(1, reach)):
            p = p[is_run[p + sign * k]]
        at += p.tolist()
    # a shorter run can only hold encoded plain text: four groups of what that looks like
    if n >= 16:
        group = PLACES[0][data[: n - 3]]
        for k in (1, 2, 3):
            group &= PLACES[k][data[k : n - 3 + k]]
        at += np.flatnonzero(group[:-12] & group[4:-8] & group[8:-4] & group[12:]).tolist()
    return np.unique(np.searchsorted(starts, np.asarray(at, np.int64), side="right") - 1) if at else np.zeros(0, np.int64)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and the offset of each row's start and of the end."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans ARRAY<STRUCT<start, kind, stop>> of base kinds (base) and of all kinds (spans), one row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("stop", pa.int32())])
        for batch in batches:
            if not batch.num_rows:
                continue
            data, off = text_bytes(batch.column(1).fill_null(""))
            base, every = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            starts = off[:-1]
            for i in suspects(data, starts).tolist():
                base[i], every[i] = all_spans(data[off[i] : off[i + 1]].tobytes().decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([[dict(zip(("start", "kind", "stop"), s, strict=True)) for s in row] for row in rows], pa.list_(span)) for rows in (base, every))], names=["doc_id", "base", "spans"])

    kind = "array<struct<start:int,kind:string,stop:int>>"
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, f"doc_id bigint, base {kind}, spans {kind}")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span that the scan reports replaced by mark; null texts stay null; other columns are untouched.

    Overlapping spans become one mark. n_chars, where docs has it, follows the new text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.schema.get_field_index("text")
            column = batch.column(k)
            data, off = text_bytes(column.fill_null(""))
            new = {}
            for i in suspects(data, off[:-1]).tolist():
                text = data[off[i] : off[i + 1]].tobytes().decode()
                out, done = [], 0
                for a, _, b in all_spans(text)[1]:
                    if a >= done:
                        out += [text[done:a], mark]
                    done = max(done, b)
                if done:
                    new[i] = "".join(out) + text[done:]
            if new:
                texts = column.to_pylist()
                for i, text in new.items():
                    texts[i] = text
                column = pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays([column if j == k else batch.column(j) for j in range(batch.num_columns)], schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def digest(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents")))
