"""Secret scan: an Aho-Corasick pass finds keywords, anchored patterns look only where one was found, and tokens
that carry a checksum or a structure of their own are taken only if it holds."""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, utf8

ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Kinds in the order in which spans of one start are listed; the first three are the base rules.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "key_block")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
PATTERNS = {
    "assign": ASSIGN,
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++"),
}
#: A run of a web token's characters: what a failed match at one of its places says holds for all of them.
RUN = re.compile(r"[A-Za-z0-9_-]*+")
#: A key block by its parts, so that lines which many beginnings share are read once.
BEGIN = re.compile(r"-----BEGIN ([A-Z]++ )?PRIVATE KEY-----\s*+")
HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*+:[^\r\n]*+\r?\n")
HEADERS = re.compile(rf"(?:{HEADER.pattern})*+")
BODY = re.compile(r"([A-Za-z0-9+/=\s]++)-----END ([A-Z]++ )?PRIVATE KEY-----")
#: Runs of hex digits have no keyword; this pattern is anchored by its own character class.
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyj",),
    "key_block": ("-----begin",),
}


def checksummed(m: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    n, out = zlib.crc32(m[1].encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = ALNUM[r] + out
    return out == m[2]


def web_token(m: re.Match) -> bool:
    """Header and claims are JSON objects, and the header names an algorithm."""
    try:
        parts = [json.loads(base64.urlsafe_b64decode(m[i] + "=" * (-len(m[i]) % 4))) for i in (1, 2)]
    except (ValueError, binascii.Error, RecursionError):
        return False
    return all(isinstance(p, dict) for p in parts) and "alg" in parts[0]


def key_body(headers: str, packed: str) -> bool:
    """The body is base64 of a DER sequence or an OpenSSH key, or of whole cipher blocks if a header line says so."""
    try:
        body = base64.b64decode("".join(packed.split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if re.search(r"^Proc-Type:.*\bENCRYPTED\b", headers, re.M):
        return len(body) > 0 and len(body) % 8 == 0
    return body.startswith((b"\x30", b"openssh-key-v1\0"))


class Blocks:
    """Key blocks of one text; header lines and bodies that several beginnings lead to are read once."""

    def __init__(self, text: str):
        self.text, self.lines, self.bodies = text, (0, 0), {}

    def headers_end(self, at: int) -> int:
        a, b = self.lines
        if a <= at < b:  # behind its own line this run of header lines goes on as the one read before
            return b if HEADER.match(self.text, at) else at
        self.lines = at, HEADERS.match(self.text, at).end()
        return self.lines[1]

    def match(self, start: int) -> tuple[int, bool] | None:
        """(end, whether the body is one of a key) of the block that begins here."""
        begin = BEGIN.match(self.text, start)
        if begin is None:
            return None
        at = self.headers_end(begin.end())
        if at not in self.bodies:
            self.bodies[at] = BODY.match(self.text, at)
        body = self.bodies[at]
        if body is None or body[2] not in (None, begin[1]):
            return None
        return body.end(), key_body(self.text[begin.end() : at], body[1])


VALID = {
    "assign": lambda m: len(m[2]) >= 12,
    "access": lambda m: len(m[0]) >= 18,
    "github": checksummed,
    "npm": checksummed,
    "jwt": web_token,
}


class Scanner:
    def __init__(self) -> None:
        import ahocorasick

        self.hits = ahocorasick.Automaton()
        for kind, keywords in KEYWORDS.items():
            for k in keywords:
                self.hits.add_word(k, (len(k), kind))
        self.hits.make_automaton()

    def __call__(self, raw: bytes) -> list[tuple[int, int, str]]:
        """(start, end, kind) in code points, by start and then by kind as listed; leftmost, without overlap within a kind."""
        text = raw.decode()
        found, past, blocks = [], dict.fromkeys(KINDS, 0), Blocks(text)
        near = sorted((end - n + 1, kind) for end, (n, kind) in self.hits.iter(raw.lower().decode()))  # lower() of bytes: A-Z alone
        for start, kind in near:
            if start < past[kind]:
                continue
            if kind == "key_block":
                end, holds = blocks.match(start) or (start, False)
            elif m := PATTERNS[kind].match(text, start):
                end, holds = m.end(), VALID[kind](m)
            else:
                end, holds = RUN.match(text, start).end() if kind == "jwt" else start, False
            past[kind] = end  # what matches and fails its check takes its characters too
            if holds:
                found.append((start, end, kind))
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of start, end, kind), a row for each row of docs.

    Null, empty and clean texts have no spans; repeated rows are scanned again, null doc_ids stay null, other
    columns are not read, and an empty table gives an empty one. Spans of one start come by kind as KINDS lists them.
    Work and memory follow the text's length, however long: a run or header lines that failed once are not read again.
    """
    small_batches(docs.sparkSession)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("spans", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner()
        for b in batches:
            spans = [[{"start": x, "end": y, "kind": k} for x, y, k in scan(t)] for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, arrow)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 of the base spans' list, and the list of all spans."""
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counted = [count(k) for k in KINDS[:3]]
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return find_secrets(docs).select("doc_id", *counted, F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
