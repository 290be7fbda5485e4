"""Secret scans by multipart credential linking.

A credential has parts: an access identifier, a secret and an endpoint. Strong
parts (the three base kinds) are reported wherever they stand. Weak candidates
(a short or merely labelled identifier, a short or unlabelled secret, an
endpoint) are reported only when the complementary parts stand near them in
the same scope. Linking is an interval join of the sorted part lists of a
text: two binary searches per candidate, so a text with very many parts costs
n log n and never a pair list. A scope is a paragraph (blank lines part them),
and parts link over at most ``REACH`` code points.

Defined cases: a null text counts as empty; an empty text has no spans; texts
are scanned whole at any length; rows are independent of each other, so
repeated rows, ties, null ids and empty tables need no rule of their own.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quarry.llm.common import pick, whole_text

REACH = 200
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
BASE = KINDS[:3]

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run is found whole, shorter runs never match

LABELLED_ID = re.compile(
    r"""(?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}""",
    re.ASCII)
BARE_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}")
ENDPOINT = re.compile(r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?::\d{1,5})?(?![\d.])""",
                      re.ASCII)
BLANK_LINES = re.compile(r"\n[ \t\r]*\n\s*")

SPAN = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                             StructField("end", IntegerType())]))


class Parts:
    """Non-overlapping intervals of one role in text order."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans.sort()
        self.starts = [s for s, _ in spans]
        self.ends = [e for _, e in spans]

    def meets(self, low: int, high: int) -> bool:
        """Is there an interval with end >= low and start <= high?"""
        i = bisect.bisect_left(self.ends, low)
        return i < len(self.starts) and self.starts[i] <= high


def _mixed(text: str) -> bool:
    return any(c.isdigit() for c in text) and any(c.islower() for c in text) and any(c.isupper() for c in text)


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]], list[tuple[int, int]]]:
    """The base spans, and the near misses of assign and access."""
    found: list[tuple[str, int, int]] = []
    short_assign, short_access = [], []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[1]) >= 12:
                found.append(("assign", m.start(), m.end()))
            else:
                short_assign.append(m.span())
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 18:
            found.append(("access", m.start(), m.end()))
        else:
            short_access.append(m.span())
    found.extend(("hex", m.start(), m.end()) for m in HEX.finditer(text))
    return found, short_assign, short_access


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then kind."""
    base, weak_secrets, weak_ids = base_spans(text)
    if "=" in text or ":" in text:
        weak_ids.extend(m.span() for m in LABELLED_ID.finditer(text))
    weak_secrets.extend(m.span() for m in BARE_SECRET.finditer(text) if _mixed(m[0]))
    endpoints = [m.span() for m in ENDPOINT.finditer(text)] if "." in text or "://" in text else []
    found = list(base)
    if weak_secrets or weak_ids or endpoints:
        taken = Parts(_merged([(s, e) for _, s, e in base]))
        free = lambda spans: [(s, e) for s, e in spans if not taken.meets(s + 1, e - 1)]
        weak_ids, weak_secrets, endpoints = free(weak_ids), free(weak_secrets), free(endpoints)
        urls = Parts(_merged(list(endpoints)))
        weak_secrets = [(s, e) for s, e in weak_secrets if not urls.meets(s + 1, e - 1)]
        ids = Parts(_merged([(s, e) for k, s, e in base if k == "access"] + weak_ids))
        secrets = Parts(_merged([(s, e) for k, s, e in base if k != "access"] + weak_secrets))
        breaks = [m.span() for m in BLANK_LINES.finditer(text)]
        scope_ends, scope_starts = [s for s, _ in breaks], [0, *(e for _, e in breaks)]

        def window(start: int, end: int) -> tuple[int, int]:
            scope = bisect.bisect_right(scope_starts, start) - 1
            low = max(start - REACH, scope_starts[scope])
            high = min(end + REACH, scope_ends[scope] if scope < len(scope_ends) else len(text))
            return low + 1, high - 1  # a part must reach into the window

        found.extend(("identifier", s, e) for s, e in weak_ids if secrets.meets(*window(s, e)))
        found.extend(("secret", s, e) for s, e in weak_secrets
                     if ids.meets(*window(s, e)) or urls.meets(*window(s, e)))
        found.extend(("endpoint", s, e) for s, e in endpoints
                     if ids.meets(*window(s, e)) and secrets.meets(*window(s, e)))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans joined, so that starts and ends both ascend."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


@F.pandas_udf(SPAN)
def secret_spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)] for t in texts],
                        index=texts.index, dtype=object)


@F.pandas_udf(StringType())
def redacted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The text with every span replaced by a mark; null stays null."""
    for texts in parts:
        yield texts.map(lambda t: None if t is None else redact(t))


def redact(text: str) -> str:
    spans = _merged([(s, e) for _, s, e in find_spans(text)])
    out, at = [], 0
    for s, e in spans:
        out += [text[at:s], "[SECRET]"]
        at = e
    return "".join(out) + text[at:] if spans else text


def scan_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, spans) for every row; see the module's text for the rules."""
    rows = pick(df, doc_id=id_column, text=text_column)
    return rows.select(rows.doc_id, secret_spans(whole_text("text")).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """The span lists as counts, joined text and a hash of the base spans."""
    base = F.filter("spans", lambda x: x.kind.isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    return scanned.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_linked"))
