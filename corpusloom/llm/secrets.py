"""Secret scan with multipart credential linking.

Base kinds (``assign``, ``access``, ``hex``) are reported wherever they stand. Weak candidates -
account names, short or unlabelled secrets, service addresses - mean nothing alone: an interval
join over the sorted spans of a text links them with complementary parts in the same scope, and
only linked ones are reported. A scope is a paragraph, and in it a window of ``SCOPE`` characters
on either side of a span.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "identifier", "weak_secret", "endpoint")
SCOPE = 300

ASSIGN = re.compile(r"""(?ia:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
IDENTIFIER = re.compile(r"""(?ia:\b(?:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,}))""")
NAMED = re.compile(r"""(?ia:\b(?:pwd|pass|pin|private_?key|credential|auth)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=!@#-]{4,}))""")
BLOB = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[^\s]{0,39}\d)[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"(?a:\b(?:https?|jdbc:\w+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+)")
#: Characters without which none of the weak patterns but BLOB can match.
_SIGNS = re.compile("[:=]")
_LONG = re.compile("[A-Za-z0-9+/]{40}")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def base_spans(text: str) -> list[Span]:
    found = [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates that overlap no base span."""
    found: list[Span] = []
    if _SIGNS.search(text):
        found += [Span(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text)]
        found += [Span(m.start(), 4, m.end()) for m in NAMED.finditer(text)]
        found += [Span(m.start(), 4, m.end()) for m in ASSIGN.finditer(text) if 4 <= len(m[1]) < 8]
        found += [Span(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    if _LONG.search(text):
        found += [Span(m.start(), 4, m.end()) for m in BLOB.finditer(text) if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0])]
    starts = [b.start for b in base]
    reach, most = [], 0
    for b in base:
        reach.append(most := max(most, b.end))
    return sorted(s for s in set(found) if not ((k := bisect_left(starts, s.end)) and reach[k - 1] > s.start))


def linked(text: str, base: list[Span], weak: list[Span], scope: int = SCOPE) -> list[Span]:
    """The weak spans with complementary parts in their scope: an identifier needs a secret, a weak
    secret an identifier or an access key, an endpoint both."""
    if not weak:
        return []
    sides = {"id": sorted(s for s in [*base, *weak] if s.kind in (1, 3)), "secret": sorted(s for s in [*base, *weak] if s.kind in (0, 2, 4))}
    starts = {k: [s.start for s in v] for k, v in sides.items()}
    longest = {k: max((s.end - s.start for s in v), default=0) for k, v in sides.items()}

    def near(span: Span, side: str) -> bool:
        before = text.rfind("\n\n", max(0, span.start - scope), span.start)
        after = text.find("\n\n", span.end, span.end + scope)
        lo = before + 2 if before >= 0 else span.start - scope
        hi = after if after >= 0 else span.end + scope
        held = sides[side]
        for k in range(bisect_left(starts[side], lo - longest[side]), bisect_right(starts[side], hi)):
            if held[k] != span and held[k].end > lo and held[k].start < hi:
                return True
        return False

    wants = {3: ("secret",), 4: ("id",), 5: ("id", "secret")}
    return [s for s in weak if all(near(s, side) for side in wants[s.kind])]


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    text = text or ""
    base = base_spans(text)
    return base, linked(text, base, weak_spans(text, base))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and an array of (kind, start, end, base) in order of start, then kind; code points,
    end exclusive. One row per row of ``docs``; null, empty and clean texts have an empty array."""

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            out = []
            for text in batch.column(1):
                base, weak = scan(text.as_py())
                out.append([{"kind": KINDS[s.kind], "start": s.start, "end": s.end, "base": s.kind < 3} for s in sorted([*base, *weak])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def secrets_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of what ``find_secrets`` found."""
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_linked"))


def sha256_of(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
