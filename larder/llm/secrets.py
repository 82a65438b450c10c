"""Secret scan: patterns, and candidates that are reported only if their structure is confirmed.

Three plain patterns find assignments, access key ids and long hex strings. Runs of base64 or hex
are decoded: a key is reported if its DER structure parses with every nested length filling its
parent, or if it is an OpenSSH private key whose length fields add up; a signed token if its header
and payload are JSON objects, the header names an algorithm and a signature follows. Lines of base64
that follow each other, also with escaped newlines, are one run, and a key may begin inside a run.
"""

import base64
import binascii
import bisect
import itertools
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# fixed values: the plain patterns and the kinds in their order
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is as long as it can be, so shorter ones need not be found
KINDS = ["assign", "access", "hex", "pem_key", "der_key", "ssh_key", "jwt"]
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
ASSIGN_FROM, ACCESS_FROM = 6, 20

PEM_BEGIN = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_ANY = re.compile(r"(?:[0-9a-f]{64,}|[0-9A-F]{64,})")
SSH_MAGIC = b"openssh-key-v1\0"
# keys with headers, over several lines, with escaped newlines, or inside a run
NEWLINE = re.compile(r"(?:[\r\n]|\\{1,4}[rn])+")
JOIN = re.compile(r"""[ \t"',]*(?:[\r\n]|\\{1,4}[rn])(?:[\s"',>#*]|\\{1,4}[rn])*""")
RUN = re.compile(r"[A-Za-z0-9+/_-]+")
LINES = re.compile(rf"[A-Za-z0-9+/_-]{{40,}}(?:{JOIN.pattern}[A-Za-z0-9+/_-]+)*")
KEY_START = re.compile(r"M(?=[A-P])|b3BlbnNzaC1rZXktdjE")
DEK_INFO = re.compile(r"DEK-Info: *[A-Z0-9-]+, *[0-9A-Fa-f]{16,}")
PASSWORD_OIDS = (b"\x2a\x86\x48\x86\xf7\x0d\x01\x05", b"\x2a\x86\x48\x86\xf7\x0d\x01\x0c\x01")


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER elements that fill start to end; None if they don't."""
    found = []
    while start < end:
        if end - start < 2:
            return None
        tag, size, start = data[start], data[start + 1], start + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or start + n > end:
                return None
            size, start = int.from_bytes(data[start:start + n], "big"), start + n
        if start + size > end:
            return None
        found.append((tag, start, start + size))
        start += size
    return found


def _nested(data: bytes, start: int, end: int, depth: int = 0) -> bool:
    """Do all constructed elements parse down to their leaves?"""
    parts = _elements(data, start, end)
    return parts is not None and depth < 16 and all(
        _nested(data, a, b, depth + 1) for tag, a, b in parts if tag & 0x20)


def is_private_der(data: bytes) -> bool:
    """PKCS#1 and DSA (only integers), SEC 1 (version, octets), PKCS#8 (version, algorithm, octets), encrypted or not."""
    outer = _elements(data, 0, len(data)) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1 or not _nested(data, 0, len(data)):
        return False
    inner = _elements(data, outer[0][1], outer[0][2])
    tags = [tag for tag, _, _ in inner]
    if tags == [0x30, 4]:  # EncryptedPrivateKeyInfo: encrypted by a password, unlike other digests and boxes
        algorithm = _elements(data, inner[0][1], inner[0][2])
        return (bool(algorithm) and algorithm[0][0] == 6 and inner[1][2] - inner[1][1] >= 16
                and data[algorithm[0][1]:algorithm[0][2]].startswith(PASSWORD_OIDS))
    if tags[:1] != [2] or inner[0][2] - inner[0][1] != 1:
        return False
    version = data[inner[0][1]]
    if version == 0 and len(tags) in (6, 9) and set(tags) == {2}:
        return True
    if version == 1 and len(tags) >= 2 and tags[1] == 4 and inner[1][2] - inner[1][1] >= 16:
        return True
    if version <= 1 and tags[1:3] == [0x30, 4]:
        algorithm = _elements(data, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 6
    return False


def _ssh_size(read: Callable[[int, int], bytes], most: int) -> int:
    """Bytes of the OpenSSH key at the start of `most` bytes, by its length fields; 0 if there is none.

    read(at, n) gives n bytes: only the fields are read.
    """
    if read(0, len(SSH_MAGIC)) != SSH_MAGIC:
        return 0
    at, fields, last = len(SSH_MAGIC), 0, 6
    while fields < last:
        if at + 4 > most:
            return 0
        size = int.from_bytes(read(at, 4), "big")
        if fields == 3:  # the number of keys is not a length
            if not 1 <= size <= 16:
                return 0
            at, fields, last = at + 4, 4, size + 5
            continue
        at, fields = at + 4 + size, fields + 1
    return at if at <= most else 0


def is_private_ssh(data: bytes) -> bool:
    """cipher, derivation, its options, a count, public keys and the private part, by lengths."""
    if not data.startswith(SSH_MAGIC):
        return False
    at, fields = len(SSH_MAGIC), 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if fields == 3:  # the number of keys is not a length
            if not 1 <= size <= 16:
                return False
            at, fields = at + 4, 4
            continue
        if at + 4 + size > len(data):
            return False
        at, fields = at + 4 + size, fields + 1
    return fields >= 6 and at == len(data)


def _decoded(text: str) -> bytes | None:
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der_key" if is_private_der(data) else "ssh_key" if is_private_ssh(data) else None


def _der_size(data: bytes) -> int:
    """Bytes of the sequence that data starts with, if a version or an algorithm comes first in it; else 0."""
    if len(data) < 8 or data[0] != 0x30:
        return 0
    n = data[1] & 0x7F if data[1] & 0x80 else 0
    if n > 4 or data[1] == 0x80 or data[2 + n:3 + n] not in (b"\x02", b"\x30"):
        return 0
    return 2 + n + (int.from_bytes(data[2:2 + n], "big") if n else data[1])


def _wrapped_keys(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Keys that begin anywhere in text[start:end], which is base64 in one or several lines."""
    runs = [m.span() for m in RUN.finditer(JOIN.sub(lambda m: " " * len(m[0]), text[start:end]))]
    body = "".join(text[start + a:start + b] for a, b in runs)
    ends = list(itertools.accumulate(b - a for a, b in runs))

    def place(k: int) -> int:
        i = bisect.bisect_right(ends, k)
        return start + runs[i][1] - (ends[i] - k)

    done = 0
    for m in KEY_START.finditer(body):
        if m.start() < done:
            continue
        if m[0][0] == "b":
            read = lambda at, n, k=m.start(): (_decoded(body[k + at // 3 * 4:k + (at + n + 2) // 3 * 4]) or b"")[at % 3:][:n]
            size = _ssh_size(read, (len(body) - m.start()) * 3 // 4)
        else:
            size = _der_size(_decoded(body[m.start():m.start() + 16]) or b"")
        chars = -(-size * 4 // 3)
        if not size or m.start() + chars > len(body):
            continue
        data = (_decoded(body[m.start():m.start() + chars]) or b"")[:size]
        kind = _key_kind(data)
        if kind:
            done = m.start() + -(-len(data) * 4 // 3)
            at = place(done - 1) + 1
            pad = -len(data) % 3
            yield kind, place(m.start()), at + (pad if text[at:at + pad] == "=" * pad else 0)


def _is_pem_key(body: str) -> bool:
    """Is what stands between the BEGIN and END lines a key? Lines may end in escaped newlines."""
    lines = [line.strip() for line in NEWLINE.split(body)]
    heads = [line for line in lines if ":" in line]
    data = _decoded("".join("".join(line.split()) for line in lines if ":" not in line).strip("\"',"))
    if any(h.startswith("Proc-Type:") and "ENCRYPTED" in h for h in heads):  # the key itself is not readable
        return any(DEK_INFO.fullmatch(h) for h in heads) and bool(data) and len(data) >= 16 and len(data) % 8 == 0
    return _key_kind(data) is not None


def _object(text: str) -> dict | None:
    data = _decoded(text)
    try:
        value = json.loads(data.decode("utf-8")) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    header, payload, signature = text.split(".")
    head = _object(header)
    return (head is not None and isinstance(head.get("alg"), str) and head["alg"].lower() != "none"
            and _object(payload) is not None and len(_decoded(signature) or b"") >= 16)


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of the whole text, by start, then kind as listed."""
    text = text or ""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_FROM]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_FROM]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    keys = []
    begins = list(PEM_BEGIN.finditer(text)) if "-----BEGIN " in text else []
    for m, upto in zip(begins, [*[b.start() for b in begins[1:]], len(text)]):
        mark = f"-----END {m[1]}-----"
        end = text.find(mark, m.end(), upto)  # a key has no other beginning in it
        if end >= 0 and _is_pem_key(text[m.end():end]):
            keys.append(("pem_key", m.start(), end + len(mark)))
    inside = lambda a: any(s <= a < e for _, s, e in keys)
    found = [(_key_kind(_decoded(m[0])), *m.span()) for m in BASE64.finditer(text) if not inside(m.start())]
    found += [(_key_kind(bytes.fromhex(m[0])), *m.span()) for m in HEX_ANY.finditer(text)
              if len(m[0]) % 2 == 0 and not inside(m.start())]
    keys += [f for f in found if f[0]]
    for m in LINES.finditer(text):
        keys += [k for k in _wrapped_keys(text, *m.span()) if not inside(k[1])]
    if "eyJ" in text:
        keys += [("jwt", *m.span()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    return sorted(spans + keys, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of kind, start, end) of every row, on whole texts.

    A null or empty text has no spans. A null doc_id stays null, repeated rows come back repeated,
    other columns are not read, an empty table gives no rows.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in find(t)]
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        run, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>")


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans as text, from the rows of scan()."""
    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return scanned.select(
        "doc_id", *[n(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def masked(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each found span, overlapping ones together, replaced by the mark."""
    if not text:
        return text
    out, at = [], 0
    for _, a, b in find(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, with secrets in the texts masked; n_chars follows, if there."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(map(masked, batch.column(at).to_pylist()), batch.schema.field(at).type)
            columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(run, StructType(docs.schema.fields))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
