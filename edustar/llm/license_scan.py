"""License scans: fuzzy search for short notices by pigeonhole seeds and bounded-error matching.

1. A text becomes its words in lower case (A-Z only), joined by single spaces, with one space at both ends.
2. A notice that may hold ``edits`` errors is cut into ``edits`` + 1 pieces. Whatever the errors, one piece
   stands unchanged, so the exact occurrences of all pieces (one Aho-Corasick pass) locate every candidate.
3. Around each seed, the spans of whole words that begin and end where the notice could are matched by the
   ``regex`` library with ``{e<=edits}``; what fits is a place with its number of edits (insertions, deletions and
   substitutions of code points). A notice without errors is its own seed, so its places are those of the seed.
4. Places of one notice that overlap compete: fewest edits first, then the leftmost, then the shortest. Notices
   without errors keep all their places.

The notices are a parameter; ``BASE`` (without errors) and ``FUZZY`` are the ones of the registered query. All work
is inside the row that holds the text, so nothing is shuffled and a text is never cut.

Defined cases: a null text counts as empty; an empty text has no words, no places, null places and score 0; very
long texts are searched whole (memory grows with one text and its places, not with its candidates); repeated rows
give repeated rows; an empty table gives an empty result; a null doc_id stays null; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in the bytes of a text in lower case: digits, letters and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    edits: int


# The phrases that the result contract names, then short notices of public licenses.
BASE = (
    Notice("mit", "mit license", 0),
    Notice("apache", "apache license", 0),
    Notice("gpl", "general public license", 0),
)
FUZZY = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "licensed under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 6),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("apache", "you may not use this file except in compliance with the license", 5),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", 6),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 6),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 5),
    Notice("boost", "boost software license version 1 0", 3),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 5),
    Notice("cc-by", "licensed under a creative commons attribution", 4),
    Notice("cc-by", "licensed under cc by 4 0", 1),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 1),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", 1),
    Notice("cc0", "creative commons zero", 1),
    Notice("reserved", "all rights reserved", 1),
)


@dataclass(frozen=True, order=True)
class Place:
    """Words ``first`` to ``last`` (inclusive, from 0) match notice number ``notice`` with ``edits`` edits."""
    first: int
    last: int
    notice: int
    edits: int


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """The notice between two spaces, cut into edits + 1 pieces of nearly equal length: (where it begins, piece)."""
    padded = f" {notice.text} "
    n = notice.edits + 1
    if len(padded) < n:
        raise ValueError(f"{notice.edits} edits are too many for {notice.text!r}")
    cuts = [len(padded) * i // n for i in range(n + 1)]
    return [(a, padded[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """The compiled notices; made once in every task."""

    def __init__(self, notices: Sequence[Notice]):
        for n in notices:
            found = [w.decode() for w in WORD.findall(n.text.encode().lower())]
            if not found or " ".join(found) != n.text:
                raise ValueError(f"a notice is words in lower case with one space between: {n.text!r}")
        self.notices = tuple(notices)

    @cached_property
    def _seeds(self) -> ahocorasick.Automaton:
        found: dict[str, list[tuple[int, int]]] = {}
        for j, notice in enumerate(self.notices):
            for at, piece in pieces(notice):
                found.setdefault(piece, []).append((j, at))
        seeds = ahocorasick.Automaton()
        for piece, where in found.items():
            seeds.add_word(piece, (len(piece), where))
        seeds.make_automaton()
        return seeds

    @cached_property
    def _fuzzy(self) -> list[regex.Pattern]:
        return [regex.compile(f"(?b)(?:{regex.escape(n.text, special_only=True)}){{e<={n.edits}}}") for n in self.notices]

    def candidates(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(notice, a, b): spaces a and b of the padded text, around whole words that a seed of the notice points at, each
        once. The unchanged piece stands where it should but for the edits before it, and the end of the place but for
        those behind it, so both shifts together are at most ``edits``."""
        seen: set[tuple[int, int, int]] = set()
        kept, reach = 1 << 16, 2 * max(len(n.text) + 2 + n.edits for n in self.notices)
        for end, (size, where) in self._seeds.iter(text):
            if len(seen) > kept:  # seeds come by their ends: what lies further behind than any place cannot come again
                seen = {c for c in seen if c[2] + reach >= end}
                kept = max(kept, 2 * len(seen))
            for j, at in where:
                notice, start = self.notices[j], end + 1 - size - at
                stop = start + len(notice.text) + 1
                if start + notice.edits < 0:
                    continue
                a = text.find(" ", max(0, start - notice.edits), start + notice.edits + 1)
                while a >= 0:
                    rest = notice.edits - abs(a - start)
                    b = text.find(" ", max(a + 2, stop - rest), stop + rest + 1)
                    while b >= 0:
                        if (j, a, b) not in seen:
                            seen.add((j, a, b))
                            yield j, a, b
                        b = text.find(" ", b + 1, stop + rest + 1)
                    a = text.find(" ", a + 1, start + notice.edits + 1)

    def verified(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """The candidates that fit: (edits, a, b, notice)."""
        for j, a, b in self.candidates(text):
            if self.notices[j].edits == 0:  # the seed is the whole notice and both spaces
                yield 0, a, b, j
            elif m := self._fuzzy[j].fullmatch(text, a + 1, b):
                yield sum(m.fuzzy_counts), a, b, j

    def places(self, words: Sequence[bytes]) -> list[Place]:
        """All places in a text's words, by first word."""
        text = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")
        found = sorted(self.verified(text))
        if not found:
            return []
        spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        out, taken = [], [_Disjoint() for _ in self.notices]
        for edits, a, b, j in found:
            if self.notices[j].edits == 0 or taken[j].take(a, b):
                first, last = np.searchsorted(spaces, (a, b))
                out.append(Place(int(first), int(last) - 1, j, edits))
        return sorted(out)


class _Disjoint:
    """Intervals taken so far, none of which overlap; each reserves the blocks of ``SIZE`` that it touches."""
    SIZE = 64

    def __init__(self):
        self.blocks: dict[int, list[tuple[int, int]]] = {}

    def take(self, a: int, b: int) -> bool:
        touched = range(a // self.SIZE, (b - 1) // self.SIZE + 1)
        if any(a < y and x < b for k in touched for x, y in self.blocks.get(k, ())):
            return False
        for k in touched:
            self.blocks.setdefault(k, []).append((a, b))
        return True


def words_of(text: str | None) -> tuple[bytes, list[bytes]]:
    """The UTF-8 of a text with A-Z in lower case, and its words."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    return raw, WORD.findall(raw)


def spans(raw: bytes, places: Sequence[Place]) -> list[tuple[int, int]]:
    """Each place's code points (end exclusive) in the text itself."""
    where = np.array([m.span() for m in WORD.finditer(raw)], np.int64)
    begins = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(begins)))
    return [(int(before[where[p.first, 0]]), int(before[where[p.last, 1]])) for p in places]


def likeness(notice: Notice, edits: int) -> float:
    return 1.0 - edits / len(notice.text)


def scan_documents(docs: DataFrame, base: Sequence[Notice] = BASE, fuzzy: Sequence[Notice] = FUZZY) -> DataFrame:
    """docs (doc_id, text, ...) -> one row per row: doc_id, n_words, n_base (places of ``base``), first_word and last_word
    (their smallest and largest start), base_labels, labels (of all notices), score (the best place's share of code
    points without an edit; 0 without a place), n_fuzzy and spans ("label:start:end:edits" of all places)."""
    if any(n.edits for n in base):
        raise ValueError("base notices have no edits")
    notices = (*base, *fuzzy)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner, n_base = Scanner(notices), len(base)
        for b in batches:
            out = []
            for text in b["text"]:
                raw, words = words_of(text)
                found = scanner.places(words) if words else []
                exact = [p for p in found if p.notice < n_base]
                labels = lambda places: ",".join(sorted({notices[p.notice].label for p in places}))
                out.append((
                    len(words), len(exact), exact[0].first if exact else None, exact[-1].first if exact else None,
                    labels(exact), labels(found), max((likeness(notices[p.notice], p.edits) for p in found), default=0.0),
                    len(found) - len(exact),
                    ",".join(f"{notices[p.notice].label}:{x}:{y}:{p.edits}" for p, (x, y) in zip(found, spans(raw, found))) if found else ""))
            got = pd.DataFrame(out, columns=["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_fuzzy", "spans"])
            got = got.astype({"first_word": "Int64", "last_word": "Int64"})
            got.insert(0, "doc_id", b["doc_id"].astype("Int64").values)
            yield got
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
             "score double, n_fuzzy long, spans string")
