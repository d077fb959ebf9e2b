"""Secret scans (operator 7).

Fixed patterns find assignments, access keys and hexadecimal strings. On top,
candidate strings are scanned with a sliding window whose Shannon entropy is
kept by incremental character counts; the limit depends on the character class
of the window (hexadecimal, alphanumeric, base64). Windows over the limit are
merged to spans. An allow list suppresses identifiers and placeholders.

Defined cases: a null or empty text has no spans; a null id is kept; repeated
rows are scanned each for itself; an empty table gives an empty result; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, per_text

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Bits per character from which a window of each class counts as random.
LIMITS = {"hex": 2.9, "alnum": 3.6, "base64": 3.8}
HEX_CHARS = frozenset("0123456789abcdefABCDEF")
#: Strings that look random but are none: UUIDs, dates, runs of the alphabet, placeholders.
ALLOW = re.compile(
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
    r"|(?:19|20)\d\d-\d\d-\d\d"
    r"|abcdefgh|01234567|12345678|qwertyui"
    r"|example|placeholder|changeme|your[_-]|xxxxxx|deadbeef|sha\d+[-_=]",
    re.IGNORECASE)

# a window holds one character more until the oldest has left it
_XLOG = [0.0, 0.0] + [n * log2(n) for n in range(2, WINDOW + 2)]
_TOP = log2(WINDOW)


def window_class(kinds: list[int], counts: dict[str, int]) -> str | None:
    """Class of a window from how many digits, letters and signs it holds; None
    for windows of letters or digits alone, which are words and numbers."""
    digits, letters, signs = kinds
    if not digits or not letters:
        return None
    if signs:
        return "base64"
    return "hex" if HEX_CHARS.issuperset(counts) else "alnum"


def _kind(ch: str) -> int:
    return 0 if ch.isdigit() else 1 if ch.isalpha() else 2


def entropy_spans(run: str) -> list[tuple[int, int]]:
    """Merged windows of ``run`` whose entropy reaches the limit of their class.

    Each step of the window changes two counts, and with them the sum of
    n*log2(n), from which the entropy follows.
    """
    counts: dict[str, int] = {}
    kinds = [0, 0, 0]
    total = 0.0
    out: list[tuple[int, int]] = []
    for i, ch in enumerate(run):
        n = counts.get(ch, 0)
        counts[ch] = n + 1
        total += _XLOG[n + 1] - _XLOG[n]
        kinds[_kind(ch)] += 1
        if i >= WINDOW:
            old = run[i - WINDOW]
            n = counts[old]
            total += _XLOG[n - 1] - _XLOG[n]
            if n == 1:
                del counts[old]
            else:
                counts[old] = n - 1
            kinds[_kind(old)] -= 1
        if i >= WINDOW - 1:
            c = window_class(kinds, counts)
            if c and _TOP - total / WINDOW >= LIMITS[c]:
                start = i - WINDOW + 1
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((start, i + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Entropy spans that no base span covers and that overlap nothing the allow list names."""
    if not _DIGIT.search(text):
        return []
    out = []
    # base spans are sorted: of those that start before a place, the one that reaches furthest
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if not _DIGIT.search(run):
            continue
        spans = entropy_spans(run)
        allowed = [x.span() for x in ALLOW.finditer(run)] if spans else []
        at = 0
        for a, b in spans:
            # both lists are in order and free of overlaps
            while at < len(allowed) and allowed[at][1] <= a:
                at += 1
            if at < len(allowed) and allowed[at][0] < b:
                continue
            a, b = a + m.start(), b + m.start()
            k = bisect_right(starts, a) - 1
            if k < 0 or reach[k] < b:
                out.append((a, 3, b))
    return out


_DIGIT = re.compile(r"[0-9]")


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()),
                    ("n_hex", pa.int64()), ("n_entropy", pa.int64()), ("base_sha256", pa.string()),
                    ("spans", pa.string())])
DDL = ("doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, "
       "base_sha256 string, spans string")


def scan_texts(ids: list, texts: list[str]) -> dict[str, list]:
    out: dict[str, list] = {f.name: [] for f in SCHEMA}
    for i, text in zip(ids, texts):
        base = base_spans(text)
        more = added_spans(text, base)
        n = [0, 0, 0]
        for _, k, _ in base:
            n[k] += 1
        out["doc_id"].append(i)
        out["n_assign"].append(n[0])
        out["n_access"].append(n[1])
        out["n_hex"].append(n[2])
        out["n_entropy"].append(len(more))
        out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
        out["spans"].append(joined(sorted(base + more)))
    return out


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: counts by kind, a digest of the base spans and all spans."""
    return documents(df, id_col, text_col).mapInArrow(per_text(scan_texts, SCHEMA), DDL)
