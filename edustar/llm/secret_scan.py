"""Secret scans: fixed patterns, and multipart credentials linked by an interval join.

Strong spans stand alone: an assigned secret, an access key id, a long hex string. Weak parts (a named
identifier, a random-looking string of one letter case or both, a service address) mean little alone; each is reported only when a
complementary part lies in its scope and does not overlap it: an identifier or an address needs a secret, a
random-looking string needs an identifier or an access key, so no value is its own complement. A part's scope is the
interval of SCOPE code points on both sides of it, cut at blank lines. The join runs inside the row that holds the text,
by bisection over the sorted part intervals, so nothing is shuffled and no pair is ever written out.

Defined cases: a null text counts as empty; an empty text has no spans; overlapping weak parts of one
kind keep the leftmost; a weak part that overlaps a strong span is dropped (the strong span stands); very long texts are
scanned whole, in time that grows with their length and the logarithm of their parts; repeated rows are scanned each; an
empty table gives an empty result; other columns, whatever their names, are not read by the scan and kept by the redaction.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCOPE = 256
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX, MIN_RANDOM = 6, 20, 24, 20

#: Kinds in their listed order.
STRONG = ("assign", "access", "hex")
WEAK = ("identifier", "random", "endpoint")
KINDS = STRONG + WEAK
_RANK = {k: i for i, k in enumerate(KINDS)}

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)  # a maximal run is a match or none, so the floor can stand in the pattern
IDENTIFIER = re.compile(
    r"\b(?:user(?:name)?|login|client_id|account(?:_id)?|access_key(?:_id)?)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]{3,})", re.I | re.A)
#: A maximal run, whatever sign stands before it (as '=' or ':'); '=' belongs to it only as closing padding.
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?" % MIN_RANDOM)
ENDPOINT = re.compile(
    r"\b(?:[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]+|(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.:-]{3,})", re.A)
BLANK_LINE = re.compile(r"\n[ \t]*\n")

Span = tuple[str, int, int]


def strong_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each fixed pattern, short ones dropped."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _random_looking(s: str) -> bool:
    """Letters of one case or both, and digits, changing kind often."""
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in s]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    if {"d", "u", "l"} <= set(kinds):
        return turns * 4 >= len(s)
    # base 32 and base 36: about a fifth or more of the signs are digits, so a quarter or more change kind; a name or
    # a path made of words and a number has few changes, a date or an id of digit groups few letters
    plain = s.rstrip("=")
    return plain.isalnum() and "d" in kinds and ("u" in kinds or "l" in kinds) and turns * 5 >= len(plain) and sum(k != "d" for k in kinds) * 3 >= len(plain)


def weak_parts(text: str, strong: list[Span]) -> list[Span]:
    found = [("identifier", *m.span()) for m in IDENTIFIER.finditer(text)]
    found += [("random", *m.span()) for m in RANDOM.finditer(text) if _random_looking(m[0])]
    found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    taken = _Intervals((a, b) for _, a, b in strong)
    return [s for s in found if not taken.meet(s[1], s[2])]


def _scopes(text: str, spans: list[Span], scope: int) -> list[tuple[int, int]]:
    """Each span's scope: it and ``scope`` code points around, not beyond a blank line."""
    breaks = [m.start() for m in BLANK_LINE.finditer(text)]
    out = []
    for _, a, b in spans:
        i = bisect_left(breaks, a)
        low = max(a - scope, breaks[i - 1] if i else 0)
        j = bisect_left(breaks, b)
        out.append((low, min(b + scope, breaks[j] if j < len(breaks) else len(text))))
    return out


def linked_parts(text: str, strong: list[Span], scope: int = SCOPE) -> list[Span]:
    """The weak parts that have a complementary part in their scope, beside them."""
    weak = weak_parts(text, strong)
    if not weak:
        return []
    parts = strong + weak
    of = lambda *kinds: _Intervals((a, b) for k, a, b in parts if k in kinds)
    secrets, names = of("assign", "hex", "random"), of("access", "identifier")
    needs = {"identifier": secrets, "endpoint": secrets, "random": names}
    return [s for s, (low, high) in zip(weak, _scopes(text, weak, scope)) if needs[s[0]].beside(low, s[1], s[2], high)]


class _Intervals:
    """Intervals by start (with the furthest end so far) and by end: each test is a bisection or two."""

    def __init__(self, intervals: Iterable[tuple[int, int]]):
        found = sorted(intervals)
        self.starts = [a for a, _ in found]
        self.ends = sorted(b for _, b in found)
        self.furthest = list(accumulate((b for _, b in found), max))

    def meet(self, start: int, end: int) -> bool:
        """Whether one overlaps [start, end)."""
        i = bisect_left(self.starts, end)
        return i > 0 and self.furthest[i - 1] > start

    def beside(self, low: int, start: int, end: int, high: int) -> bool:
        """Whether one reaches into [low, high) and lies before ``start`` or behind ``end``."""
        before, behind = bisect_right(self.ends, low), bisect_left(self.starts, end)
        return before < len(self.ends) and self.ends[before] <= start or behind < len(self.starts) and self.starts[behind] < high


def digest(spans: list[Span]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], _RANK[s[0]], s[2])))


def scan(text: str, scope: int = SCOPE) -> tuple[list[Span], list[Span]]:
    """Strong spans, and the weak ones that are part of a credential."""
    strong = strong_spans(text)
    return strong, linked_parts(text, strong, scope)


def scan_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """docs (doc_id, text, ...) -> one row per row: doc_id, counts and spans."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text in b["text"]:
                strong, weak = scan(text or "", scope)
                kinds = [k for k, _, _ in strong]
                base = digest(strong)
                out.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                            hashlib.sha256(base.encode()).hexdigest(), digest(strong + weak) if weak else base, len(weak)))
            got = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"])
            got.insert(0, "doc_id", b["doc_id"].astype("Int64").values)
            yield got
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long")


def redact(text: str | None, scope: int = SCOPE) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not text:
        return text
    strong, weak = scan(text, scope)
    if not strong and not weak:
        return text
    out, at = [], 0
    for kind, a, b in sorted(strong + weak, key=lambda s: (s[1], -s[2], _RANK[s[0]])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        else:
            at = max(at, b)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The same rows and columns with secrets replaced in ``text`` and ``n_chars`` (if there) recounted."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: redact(t, scope))
    clean = F.pandas_udf(run, "string")
    out = docs.withColumn("text", clean("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
