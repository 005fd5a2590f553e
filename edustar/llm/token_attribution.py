"""Token counts by section: offset-mapped attribution.

A whole document is encoded once. Byte-level tokens concatenate to the document's bytes, so the running
sum of token byte lengths gives every token's span, which is mapped to code points. Token spans are then
joined to section spans (sorted, tiling the text) by bisection inside the row. A token that crosses a
section boundary is allocated by an explicit rule:

- ``most``: the section that holds most of its code points, the earlier one on a tie (the query's rule);
- ``first``: the section of its first code point;
- ``share``: every section it touches, by its share of code points.

Under every rule a document's section counts sum to its token count. Sections are the text's lines, each
with its line feed, or given fields laid one after another (``attribute_fields``).

Defined cases: a null text counts as empty; an empty text is one section without tokens; an empty line is a
section of its line feed; repeated rows are counted each; a very long text is encoded whole, one with a run of LONG_SPACE
or more white-space characters (on which the tokenizer's pattern search gives up) piece by piece, with the same ids; an
empty table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("most", "first", "share")
LONG_SPACE = 10_000
_LONG_SPACE = re.compile(rf"(?<!\s)\s{{{LONG_SPACE}}}").search


class ByteBpe:
    """Byte-level BPE from a file of base64 tokens and ranks."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.cut, self.piece = regex.compile(pattern).findall, self.encoding._core_bpe.encode_single_piece
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def encode(self, text: str) -> list[int]:
        if len(text) < LONG_SPACE or not _LONG_SPACE(text):
            return self.encoding.encode_ordinary(text)
        return [i for piece in self.cut(text) for i in self.piece(piece.encode("utf-8", "replace"))]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, end) in code points. A token that holds part of a character's bytes spans the character."""
        ids = np.array(self.encode(text), np.int64)
        length = self.lengths[ids]
        ends = np.cumsum(length)
        starts = ends - length
        if not text.isascii():
            lead = (np.frombuffer(text.encode("utf-8", "replace"), np.uint8) & 0xC0) != 0x80
            chars = np.cumsum(lead)  # code points begun up to and with each byte
            starts, ends = chars[starts] - 1, chars[ends - 1]
        return ids, starts, ends


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def line_sections(text: str) -> np.ndarray:
    """Where each line begins, and the text's length."""
    breaks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") == 10) + 1
    inner = breaks[breaks < len(text)]
    return np.concatenate(([0], inner, [len(text)]))


def allocate(starts: np.ndarray, ends: np.ndarray, edges: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Token spans and section edges -> (tokens of each section, boundary-crossing tokens that it got or shares)."""
    n = len(edges) - 1
    begun = np.searchsorted(starts, edges[1:-1])  # tokens that begin before each inner edge
    tokens = np.diff(np.concatenate(([0], begun, [len(starts)]))).astype(float)
    crossing = np.zeros(n)
    over = (begun > 0) & (ends[begun - 1] > edges[1:-1]) if len(ends) else np.zeros(0, bool)
    for i in np.unique(begun[over]) - 1:
        s = np.arange(np.searchsorted(edges, starts[i], side="right") - 1, np.searchsorted(edges, ends[i], side="left"))
        part = np.minimum(ends[i], edges[s + 1]) - np.maximum(starts[i], edges[s])
        tokens[s[0]] -= 1
        if rule == "share":
            tokens[s] += part / part.sum()
            crossing[s] += 1
        else:
            to = s[0] if rule == "first" else s[np.argmax(part)]
            tokens[to] += 1
            crossing[to] += 1
    return tokens, crossing


def attribute_lines(docs: DataFrame, tokenizer: str, pattern: str, rule: str = "most") -> DataFrame:
    """One row for each document and line: doc_id, section, start, end, n_tokens, n_crossing."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer, pattern)
        for b in batches:
            parts, ids = [], []
            for text in b["text"]:
                edges = line_sections(text or "")
                _, starts, ends = bpe.spans(text or "")
                tokens, crossing = allocate(starts, ends, edges, rule)
                parts.append((np.arange(len(tokens)), edges[:-1], edges[1:], tokens, crossing))
                ids.append(len(tokens))
            if parts:
                section, start, end, tokens, crossing = (np.concatenate(x) for x in zip(*parts))
                yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").repeat(ids).values, "section": section, "start": start, "end": end,
                                    "n_tokens": tokens, "n_crossing": crossing.astype(np.int64)})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, section long, start long, end long, n_tokens double, n_crossing long")


def attribute_fields(rows: DataFrame, fields: Sequence[str], tokenizer: str, pattern: str, rule: str = "most", between: str = "\n") -> DataFrame:
    """One row for each row and field of ``fields``, encoded as one text in which ``between`` ends every field
    but the last; null fields are empty. Returns doc_id, field, start, end, n_tokens, n_crossing."""
    fields = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(tokenizer, pattern)
        for b in batches:
            out = []
            for doc_id, *values in zip(b["doc_id"].astype("Int64"), *(b[f] for f in fields)):
                values = [v or "" for v in values]
                values[:-1] = [v + between for v in values[:-1]]
                edges = np.concatenate(([0], np.cumsum([len(v) for v in values])))
                _, starts, ends = bpe.spans("".join(values))
                tokens, crossing = allocate(starts, ends, edges, rule)
                out += zip([doc_id] * len(fields), fields, edges[:-1], edges[1:], tokens, crossing.astype(np.int64))
            yield pd.DataFrame(out, columns=["doc_id", "field", "start", "end", "n_tokens", "n_crossing"])
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f).cast("string").alias(f) for f in fields]).mapInPandas(
        run, "doc_id long, field string, start long, end long, n_tokens double, n_crossing long")
