"""Secret scanning by patterns and by novelty under a primed compressor.

Fixed patterns find assignments, access keys and long hex runs.  Beyond them, a string of letters, digits
and marks beside a sensitive word is a candidate.  Its novelty is what it adds to the compressed size of
the text on both sides of it, with a zstandard compressor primed with common identifiers and code: a
name or a value seen nearby adds little, random characters add nearly their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm.text import fresh

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")

# Words that make a context sensitive.
SENSITIVE = (
    "auth", "bearer", "credential", "cookie", "key", "license", "passphrase", "password", "private", "pwd",
    "secret", "session", "signature", "token",
)
WORD = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
#: What may follow a sensitive word in its identifier, then any blanks and tabs with or without a separator, then the candidate.
SUFFIX = re.compile(r"[A-Za-z0-9_.-]*+", re.ASCII)
CANDIDATE = re.compile(r"""["']?(?:[\x20\t]*+(?:=>|[:=])[\x20\t]*+|[\x20\t]++)["']?([A-Za-z0-9+/_.=~-]{16,})""", re.ASCII)

# What the compressor knows beforehand: names and phrases that are common in code and settings.
IDENTIFIERS = (
    "self return import from class public static final void string int boolean const function export default "
    "config settings application environment variable username user_name email address host localhost port "
    "database connection client_id client_secret access_token refresh_token api_key private_key public_key "
    "Authorization: Bearer Content-Type: application/json http://www. https://api. .example.com/v1/ .com .org .net "
    "true false null None undefined key value name type data result response request header session cookie "
    "BEGIN RSA PRIVATE KEY END ssh-rsa sha256 sha1 md5 base64 uuid 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ change_me your_password_here placeholder example test development production"
)
#: Code points before a candidate, and as many after it, that it is measured against.
CONTEXT = 256
#: Least share of a candidate's length that it must add to the compressed size.
NOVELTY = 0.72

SPANS = "array<struct<kind:string,start:bigint,end:bigint,novelty:double>>"


class Novelty:
    """Marginal compressed bytes of a string in its context, by a primed compressor."""

    def __init__(self, dictionary: str = IDENTIFIERS, level: int = 12):
        import zstandard

        primed = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.size = lambda text: len(zstandard_compress(text.encode("utf-8", "replace")))
        zstandard_compress = zstandard.ZstdCompressor(
            level=level, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False
        ).compress

    def share(self, before: str, candidate: str, after: str = "") -> float:
        return (self.size(before + candidate + after) - self.size(before + after)) / max(1, len(candidate))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the strings beside identifiers with a sensitive word.

    Each identifier is read once.  One that ends inside a candidate is a part of it and has no other.
    """
    done = inside = 0
    for m in WORD.finditer(text):
        if m.start() < done:
            continue
        done = SUFFIX.match(text, m.end()).end()
        if done >= inside and (c := CANDIDATE.match(text, done)):
            inside = c.end()
            yield c.span(1)


def find(text: str, novelty: Novelty) -> list[tuple[int, int, int, float | None]]:
    """(start, place of the kind, end, novelty) of all spans, in order; positions are code points, ends exclusive."""
    out: list[tuple[int, int, int, float | None]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), None) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), None) for m in HEX.finditer(text)]
    if any(w in low for w in SENSITIVE):
        base = sorted((a, b) for a, _, b, _ in out)
        for a, b in candidates(text):
            if any(x < b and a < y for x, y in base):
                continue
            # A later copy of the candidate itself does not make it known, else a secret that stands twice were lost.
            after = text[b : b + CONTEXT + b - a].replace(text[a:b], "")[:CONTEXT]
            share = novelty.share(text[max(0, a - CONTEXT) : a], text[a:b], after)
            if share >= NOVELTY:
                out.append((a, 3, b, round(share, 6)))
    return sorted(out, key=lambda s: s[:3])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `spans` to every row: kind, start, end (code points, end exclusive) and the novelty of a novel string.

    Spans are in order of start, then of kind.  Within a kind they don't overlap; a novel string overlaps none of the
    others.  A null text is an empty one and has none.  Repeated rows stay, an empty table gives an
    empty one; a taken name gets an underscore.
    """
    name = fresh(docs, "spans")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType.fromDDL(f"x {SPANS}")["x"].dataType)])
    place = docs.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            found = [
                [{"kind": KINDS[k], "start": a, "end": b, "novelty": s} for a, k, b, s in find(value.as_py() or "", novelty)]
                for value in batch.column(place)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=schema.names)

    return docs.mapInArrow(run, schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
