"""Secret scans: fixed patterns, and Shannon entropy in sliding windows.

Candidate strings are runs of the characters of encoded data.  A window slides over
a candidate; the counts of its characters change by one in and one out, and the
entropy follows from a running sum.  Each character class has its own threshold.
Windows above it are merged to spans unless the allow-list names them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from jobloom.llm.common import batch_of, ship, text_blocks

#: The base patterns, the least length of what must be long enough, and the order of kinds.
ASSIGN = re.compile(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Bits per character from which a window of a class counts.  "mixed" has both cases and digits; the others have fewer characters to draw from.
THRESHOLDS = {"hex": 3.1, "lower": 3.5, "upper": 3.5, "letters": 3.6, "mixed": 3.9}
#: Letters of each case that a window of letters alone needs: random ones have about ten, words joined by capitals few and no two capitals together.
CASES = 5
#: Allow-list: what looks random and is none. Matched against the whole candidate, or a part of it, or the sequences that a window may run through.
ALLOWED = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9/_=-]+")
#: Samples from manuals; a candidate up to the longest one is silenced whole, in a longer one the windows that touch the word.
SAMPLE, LONGEST_SAMPLE = re.compile("EXAMPLE"), 40
PART = re.compile(r"[A-Za-z0-9]{20,}")
RUNS = ("0123456789abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")

_SUMS = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]


def _kind(part: str) -> str | None:
    """The class of a candidate or part; None for letters of one case, which are words."""
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", part):
        return "hex"
    lower, upper, digit = (re.search(c, part) for c in ("[a-z]", "[A-Z]", "[0-9]"))
    if lower and upper:
        return "mixed" if digit else "letters"
    return ("lower" if lower else "upper") if digit else None


def entropy_spans(candidate: str) -> list[tuple[int, int]]:
    """Merged spans of the windows whose entropy reaches the threshold of their class, in the candidate and in its parts of letters and digits."""
    if ALLOWED.fullmatch(candidate) or any(candidate in run for run in RUNS):
        return []
    samples = [m.span() for m in SAMPLE.finditer(candidate)]
    if samples and len(candidate) <= LONGEST_SAMPLE:
        return []
    found = []
    parts = [m.span() for m in PART.finditer(candidate)]
    kind = _kind(candidate)
    if kind == "mixed" or (0, len(candidate)) in parts:
        found += _windows(candidate, kind)
    for a, b in parts:
        if b - a < len(candidate):
            found += [(a + x, a + y) for x, y in _windows(candidate[a:b], _kind(candidate[a:b]))]
    spans: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if any(a < y and x < b for x, y in samples):
            continue
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def _windows(part: str, kind: str | None) -> list[tuple[int, int]]:
    """The windows of a candidate or part of it that reach the threshold of ``kind``."""
    if kind is None:
        return []
    most = WINDOW * (log2(WINDOW) - THRESHOLDS[kind]) + 1e-9  # of the sum of c log c
    counts: dict[str, int] = {}
    total, found = 0.0, []
    for i, ch in enumerate(part):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += _SUMS[c + 1] - _SUMS[c] if c < WINDOW else 0.0
        if i >= WINDOW:
            old = part[i - WINDOW]
            c = counts[old]
            counts[old] = c - 1
            total -= _SUMS[min(c, WINDOW)] - _SUMS[c - 1]
        if i >= WINDOW - 1 and total <= most:
            begin = i - WINDOW + 1
            if kind == "letters" and not (CASES <= sum(x.isupper() for x in part[begin : i + 1]) <= WINDOW - CASES and re.search("[A-Z]{2}", part[begin : i + 1])):
                continue
            found.append((begin, i + 1))
    return found


def scan(text: str, entropy: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, in code points, by start and then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    for m in CANDIDATE.finditer(text):  # every long enough hex run lies within a candidate
        begin = m.start()
        found += [(begin + h.start(), begin + h.end(), "hex") for h in HEX.finditer(m[0]) if len(h[0]) >= LEAST["hex"]]
        if entropy:
            found += [(begin + a, begin + b, "entropy") for a, b in entropy_spans(m[0])]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans (kind:start:end, comma-joined).

    A null text is empty: no spans, and the hash of the empty string.  Repeated
    rows are scanned each; a null id stays null; other columns are ignored.  An
    empty table gives an empty result.  One pass over whole texts, no shuffle.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, text_column):
            all_spans = [scan(x) for x in texts]
            columns = {f"n_{k}": [sum(s[2] == k for s in spans) for spans in all_spans] for k in KINDS}
            columns["base_sha256"] = [hashlib.sha256(joined([s for s in spans if s[2] != "entropy"]).encode()).hexdigest() for spans in all_spans]
            columns["spans"] = list(map(joined, all_spans))
            fields = pa.schema([part.schema.field(id_column), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
            yield batch_of(part, [id_column], fields, **columns)

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, {counts}, base_sha256 string, spans string")
