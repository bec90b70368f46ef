"""Finds secrets, and weak ones by the parts of a credential that stand together (operator 10)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import slices

KINDS = ("assign", "access", "hex", "weak", "endpoint")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: What is a secret only next to an identifier: a bare token of 32 to 64 characters with a digit, a capital and a small
#: letter, or a short assigned value.
_BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])[A-Za-z0-9+/]{32,64}={0,2}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"(?:https?|ftp|postgres|mysql|redis|mongodb)://[^\s\"'<>]+")
#: A scope ends at an empty line; within it, parts belong together at up to this many characters.
_SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")
REACH = 300
_SHORT = 6

Span = tuple[int, int]


def base_spans(text: str) -> tuple[list[Span], list[Span], list[Span], list[Span]]:
    """Spans of assign, access and hex, and of assignments whose value is too short to count by itself."""
    assign, short = [], []
    lower = text.lower()
    if any(word in lower for word in _WORDS):
        for m in _ASSIGN.finditer(text):
            size = m.end(2) - m.start(2)
            if size >= 12:
                assign.append(m.span())
            elif size >= _SHORT:
                short.append(m.span())
    access = [m.span() for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    return assign, access, [m.span() for m in _HEX.finditer(text)], short


def _near(spans: list[Span], part: Span, low: int, high: int) -> bool:
    """Does any of the sorted, disjoint spans reach into [low, high) without being the part itself?"""
    i = bisect_left(spans, low + 1, key=lambda s: s[1])
    while i < len(spans) and spans[i][0] < high:
        if spans[i] != part:
            return True
        i += 1
    return False


def linked_spans(text: str, access: list[Span], strong: list[Span], short: list[Span]) -> tuple[list[Span], list[Span]]:
    """Weak secrets that stand near an access identifier, and endpoints that stand near an identifier and a secret.

    An interval join: each part reaches ``REACH`` characters to both sides, but not out of its scope. A candidate without
    its counterparts is not reported, nor is one inside a stronger finding.
    """
    if not access:
        return [], []
    ends = [m.start() for m in _SCOPE_END.finditer(text)]

    def window(part: Span) -> Span:
        i = bisect_left(ends, part[0])
        return max(part[0] - REACH, ends[i - 1] if i else 0), min(part[1] + REACH, ends[i] if i < len(ends) else len(text))

    def inside(part: Span, spans: list[Span]) -> bool:
        i = bisect_left(spans, part[0] + 1, key=lambda s: s[1])
        return i < len(spans) and spans[i][0] < part[1]

    taken = sorted(strong + access)
    # Disjoint and sorted, so that the lookups by end are right.
    merged: list[Span] = []
    for a, b in taken:
        if merged and a < merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    candidates = sorted(short + [m.span() for m in _BARE.finditer(text)])
    weak: list[Span] = []
    for part in candidates:
        if not inside(part, merged) and (not weak or part[0] >= weak[-1][1]) and _near(access, part, *window(part)):
            weak.append(part)
    keys = sorted(weak + strong)
    keys = [s for i, s in enumerate(keys) if i == 0 or s[0] >= keys[i - 1][1]]
    endpoint = [m.span() for m in _ENDPOINT.finditer(text)]
    endpoint = [p for p in endpoint if _near(access, p, *window(p)) and _near(keys, p, *window(p))]
    return weak, endpoint


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all findings in order."""
    assign, access, hexes, short = base_spans(text)
    weak, endpoint = linked_spans(text, access, sorted(assign + hexes), short)
    return sorted((a, k, b) for k, spans in enumerate((assign, access, hexes, weak, endpoint)) for a, b in spans)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256 (of the base spans as text), spans (as text) and findings (as structs).

    Places are in code points, ends exclusive. A null text is an empty one; every row gives a row; only the two named
    columns are read. The parts of a document are linked where its text is read, so nothing is shuffled.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    finding = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [spans_of(t or "") for t in batch.column("text").to_pylist()]
            counts = np.array([[sum(k == i for _, k, _ in r) for i in range(3)] for r in rows], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(counts[:, i]) for i in range(3)),
                 pa.array([sha256(_written([s for s in r if s[1] < 3]).encode()).hexdigest() for r in rows], pa.string()),
                 pa.array([_written(r) for r in rows], pa.string()),
                 pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in r] for r in rows], finding)],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "findings"])

    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
                             "base_sha256 string, spans string, findings array<struct<kind: string, start: long, end: long>>")
