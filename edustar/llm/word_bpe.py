"""Whole-text encoding by the word-BPE tokenizer file, with a bounded cache of words.

The tokenizer folds case, drops white space and encodes each run of letters, each digit and each run of
signs by itself, so a text's ids are its chunks' ids in order. Chunks between white space are looked up
in a cache. An unknown chunk of Latin letters and signs is cut by the tokenizer's own pattern and each
piece merged by tiktoken's byte-pair merger over the same vocabulary: a word's end is written as the byte
0xFF, which UTF-8 never has, and a token's rank is its id, which is its merge order (checked on loading).
Any other chunk goes through the tokenizers library. ``encode`` gives the ids that encoding the whole text by
the tokenizers library gives (tested), those of added tokens included.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np
import regex

#: Chunks held by each of the two generations of the cache.
CACHE_WORDS = 400_000

#: Characters that Python splits on but the tokenizer's \\s does not hold: such texts are encoded whole.
_OTHER_SPACE = re.compile("[\x1c-\x1f]")
_NOT_LATIN = re.compile("[^\x21-ɏ]")
_END = b"\xff"
_LOADED: dict[tuple, "WordBpe"] = {}


class WordBpe:
    """``plain_added``: added tokens written in a text are encoded as its other characters are, so that no text can write,
    say, a document end into a sequence; by default they give their own ids, as by the tokenizer file as loaded."""

    def __init__(self, path: str, plain_added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_added
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec["added_tokens"]]
        # case is ignored, as a token may be looked for in the normalised text; whatever this finds is encoded whole
        self.added = re.compile("|".join(map(re.escape, added)), re.I).search
        self.signs = "" if plain_added else "".join({c for t in added for c in (t[0].lower(), t[0].upper())})
        self.merger = _merger(spec)
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, plain_added: bool = False) -> "WordBpe":
        """One tokenizer, with its cache, for each Python worker."""
        key = (path, plain_added)
        if key not in _LOADED:
            _LOADED[key] = cls(*key)
        return _LOADED[key]

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_bytes(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if _OTHER_SPACE.search(text) or any(c in text for c in self.signs) and self.added(text):
            return self.encode_whole(text)
        chunks = text.split()
        found = list(map(self.young.get, chunks))
        if None in found:
            self._learn({c for c, ids in zip(chunks, found) if ids is None})
            found = list(map(self.young.get, chunks))
            if None in found:  # a new generation has begun
                self._learn(set(chunks))
                found = list(map(self.young.get, chunks))
        return b"".join(found)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def _learn(self, chunks: set[str]) -> None:
        """Put the chunks' ids into the young generation."""
        if len(self.young) > CACHE_WORDS:
            self.old, self.young = self.young, {}
        young, old, chunk = self.young, self.old, self._chunk
        for c in chunks:
            if c not in young:
                young[c] = old.get(c) or chunk(c)

    def _chunk(self, chunk: str) -> bytes:
        if self.merger is None or not chunk.isascii() and _NOT_LATIN.search(chunk):
            return self.encode_whole(chunk)
        low = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).lower()
        if low.isalpha():
            return self._piece(low)
        if low[:-1].isalpha():  # letters and one closing sign or digit: two pieces by the pattern
            return self._piece(low[:-1]) + self._piece(low[-1])
        return b"".join(map(self._piece, self.cut(low)))

    def _piece(self, piece: str) -> bytes:
        ids = self.young.get(piece) or self.old.get(piece)
        if ids is None:
            ids = array("I", self.merger(piece.encode() + _END)).tobytes()
        return ids


def _merger(spec: dict):
    """A function bytes -> ids, or None when the file is not of the expected kind."""
    import tiktoken

    model = spec["model"]
    if model.get("end_of_word_suffix") != "</w>" or [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
        return None
    vocab = model["vocab"]
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in merged or any(a >= b for a, b in zip(merged, merged[1:])) or merged[0] < 512:
        return None
    byte_of = _byte_letters()
    special = {t["content"] for t in spec["added_tokens"]}
    ranks: dict[bytes, int] = {}
    for token, i in vocab.items():
        if token in special:
            continue
        word_end = token.endswith("</w>")
        ranks[bytes(byte_of[c] for c in (token[:-4] if word_end else token)) + _END * word_end] = i
    if len(ranks) != len(vocab.keys() - special):
        return None
    return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte: printable Latin-1 bytes stand
    for themselves, the others for the letters from U+0100 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
