"""Secret scans: fixed patterns plus a sliding-window entropy test.

Candidates for the entropy test are maximal runs of token characters. A window
slides over each; its character counts and the sum of ``c * log2(c)`` are kept
incrementally, so a step costs two updates whatever the window's length. A
run's character class (hex, single-case alphanumeric, mixed) sets the threshold;
windows above it merge into spans. An allow-list suppresses runs that look
random but are not secret: UUIDs, host names, words, version numbers. What follows ``scheme:`` as ``//``, paths behind a host name and paths
of words are cut at ``/``, and each long segment is judged alone; letters are words in one case or capitalised only.
Spans found by the fixed patterns always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunked, text_batches

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE_MIN = 20
WINDOW = 20
#: Least bits a character over one window of 20, by character class.
THRESHOLDS = {"hex": 3.0, "single": 3.4, "mixed": 3.7}
ALLOWED = [re.compile(p) for p in (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    r"[0-9+./_=-]+",                                # numbers, dates, versions, rules
)]
#: Runs of which each segment between slashes is judged alone.
PATHS = [re.compile(p) for p in (
    r"[A-Za-z]+(?:[-_./+=][A-Za-z]*)*",             # words, joined words, paths of words
    r"(?:www\.|[a-z0-9-]+\.)+[a-z]{2,}(?:/.*)?",    # host names with a path
)]
HOST = re.compile(r"(?:www\.|[a-z0-9-]+\.)+[a-z]{2,}")
#: Words in one case or capitalised, with up to four digits behind; numbers.
PLAIN = re.compile(r"(?:[A-Z]+|[a-z]*(?:[A-Z]{1,5}[a-z]{2,}|An|As|At|By|Id|If|In|Is|It|My|No|Of|On|Or|To)*[A-Z]{0,5})[0-9]{0,4}|[0-9]+")
JOINTS = re.compile(r"[-_.+=]")

_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
_CLOGC = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]
_KEYWORDS = (b"passw", b"secret", b"token", b"api")

Span = tuple[str, int, int]


def _runs(data: bytes) -> list[tuple[int, int]]:
    """Maximal runs of token characters of CANDIDATE_MIN bytes or more."""
    if len(data) < CANDIDATE_MIN:
        return []
    is_token = np.zeros(len(data) + 2, dtype=np.int8)
    is_token[1:-1] = _TOKEN[np.frombuffer(data, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(is_token))
    start, end = edge[::2], edge[1::2]
    long = end - start >= CANDIDATE_MIN
    return list(zip(start[long].tolist(), end[long].tolist(), strict=True))


def char_class(run: str) -> str:
    letters = [c for c in run if c.isalpha()]
    if all(c in "0123456789abcdefABCDEF" for c in run):
        return "hex"
    one_case = all(c.islower() for c in letters) or all(c.isupper() for c in letters)
    return "single" if one_case else "mixed"


def allowed(run: str) -> bool:
    """True for runs and segments that the allow-list suppresses whole."""
    return any(p.fullmatch(run) for p in ALLOWED) or len(set(run)) <= 6


def candidates(run: str, before: str) -> list[tuple[int, str]]:
    """(offset, text) of what the entropy test looks at; ``before`` is the text just ahead of the run."""
    if allowed(run):
        return []
    url = before.endswith(":") and run.startswith("//")
    if not url and not any(p.fullmatch(run) for p in PATHS):
        return [(0, run)]
    found, at = [], 0
    for i, segment in enumerate(run.split("/")):
        if len(segment) >= CANDIDATE_MIN and not (allowed(segment) or i == (2 if url else 0) and HOST.fullmatch(segment)
                                                  or all(PLAIN.fullmatch(w) for w in JOINTS.split(segment))):
            found.append((at, segment))
        at += len(segment) + 1
    return found


def entropy_spans(run: str) -> list[tuple[int, int]]:
    """Merged windows of ``run`` whose Shannon entropy reaches the threshold of its class."""
    limit = THRESHOLDS[char_class(run)]
    most = WINDOW * (log2(WINDOW) - limit) + 1e-9  # entropy >= limit  <=>  sum c*log2(c) <= most
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        total += _CLOGC[c + 1] - _CLOGC[c]
        counts[ch] = c + 1
        if i >= WINDOW:
            old = run[i - WINDOW]
            c = counts[old]
            total += _CLOGC[c - 1] - _CLOGC[c]
            counts[old] = c - 1
        if i >= WINDOW - 1 and total <= most:
            start = i - WINDOW + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def scan(text: str | None) -> list[Span]:
    """All spans of one text as (kind, start, end) in code points, by start, then kind."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    found: list[tuple[int, int, int]] = []
    low = data.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_MIN]
    ascii_only = len(data) == len(text)
    for s, e in _runs(data):
        run = data[s:e].decode()
        at = s if ascii_only else len(data[:s].decode("utf-8", "surrogatepass"))
        if "AKIA" in run:
            found += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(run) if m.end() - m.start() >= ACCESS_MIN]
        found += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(run) if m.end() - m.start() >= HEX_MIN]
        for off, part in candidates(run, text[max(0, at - 3):at]):
            found += [(at + off + a, 3, at + off + b) for a, b in entropy_spans(part)]
    found.sort()
    return [(KINDS[k], s, e) for s, k, e in found]


def redact(text: str | None, spans: list[Span], mark: str = "[SECRET]") -> str | None:
    """``text`` with every span (overlapping ones together) replaced by ``mark``."""
    if not spans or text is None:
        return text
    out, at = [], 0
    end = -1
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= end:
            if end >= 0:
                at = end
            out += [text[at:s], mark]
            end = e
        else:
            end = max(end, e)
    return "".join(out) + text[end:]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_DDL = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans`` for every row; spans are empty for a null, empty or clean text.

    Repeated rows give repeated results; other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _SPANS)], [id_col, "spans"])

    return text_batches(docs).select(id_col, text_col).mapInArrow(run, f"`{id_col}` {id_type}, spans {SPANS_DDL}")


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with secrets in ``text_col`` replaced; no row is dropped.

    Null and empty texts stay as they are; columns may have any names.
    """
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots would not resolve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, at):
            texts = [redact(t, scan(t)) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at).name, pa.array(texts, b.schema.field(at).type))

    return text_batches(plain).mapInArrow(run, plain.schema).toDF(*docs.columns)
