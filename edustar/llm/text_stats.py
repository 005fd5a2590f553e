"""Per-text counts for the quality heuristics, vectorised over a batch (used inside tasks)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import numpy as np

from edustar.llm import words

#: Byte classes: 0 separator, 1 lower case, 2 upper case, 3 digit, 4 other ASCII sign, 5 beyond ASCII.
CLASS = np.full(256, 4, np.uint8)
CLASS[words.SPACE] = 0
CLASS[ord("a"):ord("z") + 1] = 1
CLASS[ord("A"):ord("Z") + 1] = 2
CLASS[ord("0"):ord("9") + 1] = 3
CLASS[128:] = 5

#: Fixed word list: frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that it was for on are as with be this have from by at or an not "
    "de la le et les des un une du en que est pour qui dans par sur au plus pas ce il "
    "der die und das den von zu mit sich auf für ist im dem nicht ein eine als auch es an "
    "el los las del se por con su para como más o lo y"
).split()

STATS = ("n_words", "repeated", "upper", "signs", "alike", "bars", "same_lines",
         "word_length", "digits", "plain", "function")


def text_stats(texts: Sequence[str | None]):
    """Per text: n_words, share of words equal to the one before, of upper-case letters among ASCII
    letters, of signs and of digits among visible bytes, of words that occurred before, of '|' per word, of
    lines that repeat an earlier one, mean bytes a word, shares of plain and of function words. Also the
    (case-kept) word hashes with each text's first word, and the word shapes likewise."""
    buf, at = words.joined(texts)
    hashes, first = words.word_hashes(texts, lower=False)
    n = np.diff(first)
    some = np.maximum(n, 1)
    kinds = CLASS[buf]
    count = np.stack([np.add.reduceat((kinds == k).astype(np.int64), at[:-1]) for k in range(6)]) if len(texts) else np.zeros((6, 0), np.int64)
    visible = np.maximum(count[1:].sum(0), 1)
    letters = np.maximum(count[1] + count[2], 1)
    bars = np.add.reduceat((buf == ord("|")).astype(np.int64), at[:-1]) if len(texts) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    again = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    repeated = np.bincount(doc[again], minlength=len(n))
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:])], np.int64)
    line_break = np.zeros(256, bool)
    line_break[[10, 13]] = True
    lines, first_line = words.word_hashes(texts, line_break, lower=False)
    same = np.array([b - a - len(np.unique(lines[a:b])) for a, b in zip(first_line[:-1], first_line[1:])], np.int64)
    stats = dict(n_words=n, repeated=repeated / some, upper=count[2] / letters, signs=count[4] / visible,
                 alike=1 - distinct / some, bars=bars / some, same_lines=same / np.maximum(np.diff(first_line), 1),
                 word_length=visible / some, digits=count[3] / visible,
                 function=_share(hashes, first, _function_hashes()))
    shapes = word_shapes(texts)
    stats["plain"] = _share(*shapes, _plain_hashes())
    stats["alike"] = np.where(n > 0, stats["alike"], 0.0)
    return stats, (hashes, first), shapes


def _share(h: np.ndarray, first: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
    total = np.concatenate(([0], np.cumsum(wanted[at] == h)))
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)


@cache
def _function_hashes() -> np.ndarray:
    return np.unique(words.word_hashes([" ".join([*FUNCTION_WORDS, *(w.capitalize() for w in FUNCTION_WORDS)])], lower=False)[0])


@cache
def _plain_hashes() -> np.ndarray:
    """Shapes of a word in lower case or with a capital, with one closing sign at most."""
    return np.unique(word_shapes([" ".join(w + end for w in ("ab", "Ab") for end in ("", *".,;:?!"))])[0])


def word_shapes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of word shapes (byte classes with runs of one class collapsed; signs keep their value) and
    each text's first one."""
    buf, at = words.joined(texts)
    kinds = CLASS[buf]
    shape = np.where(kinds == 4, buf, np.where(kinds == 0, np.uint8(32), np.where(kinds == 5, np.uint8(201), kinds + np.uint8(200)))).astype(np.uint8)
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    short = shape[keep]
    where = np.concatenate(([0], np.cumsum(keep)))[at]
    hashes, starts_at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    space = np.zeros(256, bool)
    space[32] = True
    for a, b in words._cuts(short, space):
        starts, ends = words.runs(short[a:b], space)
        hashes.append(words.hash_runs(short[a:b], starts, ends))
        starts_at.append(starts + a)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts_at), where)
