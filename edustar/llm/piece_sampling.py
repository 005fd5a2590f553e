"""SentencePiece sampling without replacement: Gumbel top-k by perturbed A-star search over the lattice.

A text's segmentations are the paths of its piece lattice; a path's probability is proportional to the product of its pieces'
weights (``weight``: Zipf's law over the piece's rank, flattened by ``TEMPERATURE``). Backward sums over the lattice give every
arc's exact conditional probability, so the search's bound on a sub-tree is its exact mass:

- the whole lattice gets a Gumbel value; walking down, the best path keeps it;
- every step of a walk leaves behind the sub-tree of "same prefix, another arc here", whose best value is a Gumbel of that
  sub-tree's mass, truncated at the walk's value;
- the sub-tree with the highest value is opened next: its best path is the next sample.

So the samples are distinct, in falling order of perturbed value, and distributed as drawing without replacement. The
next value that was not opened, kappa, gives each sample's inclusion score 1 - exp(-exp(log p - kappa)).

Pieces never cross a blank that begins a word, so a lattice is a chain of word lattices, and each distinct word's arcs are built once
and kept (up to ARCS in a worker). Walks are vectorised over all words of a batch. Random numbers are hashes
of (row key, sample, word, depth), the same wherever and whenever a row is computed.

Defined cases: a null text counts as empty and gives no sample; a text with fewer than k segmentations gives them all, with inclusion score 1; characters
without a piece are their UTF-8 bytes' pieces; U+2581 in a text stands for a blank and decodes to one;
repeated rows give equal samples; a null doc_id has its own fixed seed; a very long text is sampled whole, an unbroken run
of characters (one long word) in time that grows with its length; an empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edustar.llm import words

SAMPLES = 2
TEMPERATURE = 1.0
#: Arcs of distinct words kept in a worker before the store is begun anew.
ARCS = 6_000_000
#: New words built together, and characters of texts sampled together: few enough for the processor's cache.
AT_ONCE, CHARACTERS = 4_096, 1 << 18
#: Rows of an Arrow batch that become Python objects at once.
ROWS = 1_024
#: Characters from which a word is built by itself, and walks so few that they are walked one after another.
LONG_WORD, FEW = 256, 4
BLANK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOADED: dict[tuple, "Lattice"] = {}


class _Nodes(dict):
    """Word -> its first node; a word asked for the first time gets -1, -2, ... until it is built."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = -len(self.new)
        return -len(self.new)


class Lattice:
    """Pieces of a model file and the arcs of the words met so far."""

    def __init__(self, path: str, temperature: float = TEMPERATURE):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("the model must leave texts as they are")
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.dummy_prefix = model.normalizer_spec.add_dummy_prefix
        n = len(model.pieces)
        weight = lambda score: -math.log(2.0 + min(-score, n)) / temperature
        self.pieces = {p.piece: (i, weight(p.score)) for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_weight = weight(-n)
        self.text = [p.piece.encode() if p.type == kind.NORMAL else bytes([int(p.piece[1:-1], 16)]) if p.type == kind.BYTE else b""
                     for p in model.pieces]
        self.raw = pa.array(self.text, pa.binary())
        self.longest = max(map(len, self.pieces))
        inner = any(BLANK in p.strip(BLANK) or p != p.rstrip(BLANK) and p.strip(BLANK) for p in self.pieces)
        if inner or any("\n" in p for p in self.pieces):
            raise ValueError("a piece crosses the blank before a word, or a line feed")
        self.cut = re.compile(" *[^ \n]+| +|\n").findall
        self.spelled = self._spelled()
        self._empty()

    @classmethod
    def load(cls, path: str, temperature: float = TEMPERATURE) -> "Lattice":
        key = (path, temperature)
        if key not in _LOADED:
            _LOADED[key] = cls(*key)
        return _LOADED[key]

    def _empty(self) -> None:
        self.words = _Nodes()
        self.node_first = array("i")  # a node's first arc; arcs of a node fall in probability
        self.arc_up_to, self.arc_p = array("d"), array("d")  # cumulative and own conditional probability
        self.arc_next, self.arc_piece = array("i"), array("i")  # next node (-1: the word's end); piece, or -1 - index of bytes
        self.byte_pieces, self.byte_first = array("i"), array("q", [0])  # byte pieces of characters without a piece, one behind another
        self.marks: dict[str, int] = {}

    def units(self, text: str) -> list[str]:
        """The words, with plain blanks (U+2581 would double the store of a word in ASCII)."""
        text = text.replace(BLANK, " ")
        if "  " in text or not text or not self.dummy_prefix:
            return self.cut(" " + text if self.dummy_prefix and text else text)
        out: list[str] = []
        for i, line in enumerate(text.split("\n")):  # single blanks: every word but a later line's first has one before it
            if i:
                out.append("\n")
            found = line.split(" ")
            if found[-1] == "" or found[0] == "":  # a blank beside the line's end
                out += self.cut((" " if not i else "") + line)
            else:
                if not i:
                    out.append(" " + found[0])
                elif found[0]:
                    out.append(found[0])
                out += [" " + w for w in found[1:]]
        return out

    def starts(self, units: list[list[str]]) -> list[np.ndarray]:
        """The first node of each word of each text; words not met before are built."""
        if len(self.arc_p) > ARCS:  # only here, so a batch's words stay while it is worked on
            self._empty()
        found = [np.fromiter(map(self.words.__getitem__, us), np.int64, len(us)) for us in units]
        new, self.words.new = self.words.new, []
        if not new:
            return found
        try:
            short = [u for u in new if len(u) < LONG_WORD]
            for i in range(0, len(short), AT_ONCE):
                self._build(short[i:i + AT_ONCE])
            for u in new:
                if len(u) >= LONG_WORD:
                    self._build([u])
        except BaseException:
            self._empty()  # no word stays without its node
            raise
        node = np.fromiter(map(self.words.__getitem__, new), np.int64, len(new))
        for f in found:
            asked = np.flatnonzero(f < 0)
            f[asked] = node[-1 - f[asked]]
        return found

    def _spelled(self) -> tuple[np.ndarray, ...]:
        """Sorted hashes of the pieces, their ids and weights, where the hashes of each range of top bits begin, and by the top
        bits whether a piece (2) or the beginning of one (1) may have such a hash."""
        by_length: dict[int, list[str]] = {}
        for p in self.pieces:
            by_length.setdefault(len(p), []).append(p)
        found = []
        seen = np.zeros(1 << 22, np.uint8)
        for size, same in by_length.items():
            letters = np.array([[ord(c) for c in p] for p in same], np.uint64)
            h = np.zeros(len(same), np.uint64)
            for n, column in enumerate(letters.T, start=1):
                h = h * _BASE + column + np.uint64(1)
                key = words.mix(h + np.uint64(n))
                seen[key >> np.uint64(42)] |= 1
            seen[key >> np.uint64(42)] |= 2
            found += zip(key.tolist(), (self.pieces[p] for p in same))
        found.sort()
        keys = np.array([h for h, _ in found], np.uint64)
        begin = np.searchsorted(keys, np.arange(1 << 18, dtype=np.uint64) << np.uint64(46)).astype(np.int32)
        return keys, np.array([x[0] for _, x in found]), np.array([x[1] for _, x in found]), begin, seen

    def _place(self, key: np.ndarray) -> np.ndarray:
        """Where each hash stands among the pieces' hashes, or would (the last one's place at most)."""
        keys, _, _, begin, _ = self.spelled
        i = np.minimum(begin[key >> np.uint64(46)], len(keys) - 1)
        more = np.flatnonzero(keys[i] < key)
        while len(more):
            i[more] += 1
            more = more[i[more] < len(keys) - 1]
            more = more[keys[i[more]] < key[more]]
        return i

    def _build(self, new: list[str]) -> None:
        """Nodes (one a character) and arcs of new words, all at once."""
        keys, piece_ids, weights, _, seen = self.spelled
        letters = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        letters[letters == 32] = ord(BLANK)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(letters))  # characters to the word's end
        pos, size, piece, weight = [], [], [], []
        h, at = np.zeros(len(letters), np.uint64), np.arange(len(letters))
        for n in range(1, self.longest + 1):
            at = at[left[at] >= n]
            if not len(at):
                break
            h[at] = h[at] * _BASE + letters[at + n - 1] + np.uint64(1)
            key = words.mix(h[at] + np.uint64(n))
            flags = seen[key >> np.uint64(42)]
            maybe = np.flatnonzero(flags & 2)
            asked = key[maybe]
            i = self._place(asked)
            hit = keys[i] == asked
            pos.append(at[maybe[hit]])
            size.append(np.full(len(pos[-1]), n))
            piece.append(piece_ids[i[hit]])
            weight.append(weights[i[hit]])
            if n == 1:
                alone = np.ones(len(letters), bool)
                alone[pos[0]] = False
                alone = np.flatnonzero(alone)
                codes, which = np.unique(letters[alone], return_inverse=True)
                own = np.array([self._bytes_of(chr(c)) for c in codes.tolist()], np.int64).reshape(-1, 2)
                pos.append(alone)
                size.append(np.ones(len(alone), np.int64))
                piece.append(own[which, 0])
                weight.append(own[which, 1] * self.byte_weight)
            at = at[flags > 0]  # no longer piece begins like the others
        pos, size, piece, weight = map(np.concatenate, (pos, size, piece, weight))

        # backward sums, all positions at one distance from their word's end together
        step = self.longest + 1
        order = np.argsort((left[pos] * len(letters) + pos) * step + size)  # unique keys: one order whatever the sort
        pos, size, piece, weight = pos[order], size[order], piece[order], weight[order]
        back = np.zeros(len(letters) + 1)
        far = left[pos]
        cuts = np.flatnonzero(np.diff(far, prepend=0, append=far[-1] + 1))
        value = np.empty(len(pos))
        if len(new) == 1 and len(letters) >= LONG_WORD:
            value[:], back[:-1] = _backward(pos, size, weight, len(letters))
            cuts = cuts[:0]
        for x, y in zip(cuts[:-1], cuts[1:]):
            target = pos[x:y] + size[x:y]
            value[x:y] = weight[x:y] + np.where(size[x:y] < far[x], back[np.minimum(target, len(letters))], 0.0)
            first = np.flatnonzero(np.diff(pos[x:y], prepend=-1))
            top = np.maximum.reduceat(value[x:y], first)
            n = np.diff(np.append(first, y - x))
            back[pos[x:y][first]] = top + np.log(np.add.reduceat(np.exp(value[x:y] - np.repeat(top, n)), first))

        p = np.exp(value - back[pos])
        order = np.argsort((pos * (1 << 20) + ((1.0 - p) * ((1 << 20) - 1)).astype(np.int64)) * step + size)
        pos, size, piece, p = pos[order], size[order], piece[order], p[order]
        first = np.flatnonzero(np.diff(pos, prepend=-1))
        n = np.diff(np.append(first, len(pos)))
        total = np.cumsum(p)
        up_to = total - np.repeat(total[first] - p[first], n)
        up_to[first + n - 1] = 2.0  # the last arc takes what rounding leaves
        p[first[n == 1]] = 1.0
        base, arcs = len(self.node_first), len(self.arc_p)
        target = np.where(size < left[pos], base + pos + size, -1)
        for store, x in ((self.node_first, (arcs + first).astype(np.int32)), (self.arc_p, p), (self.arc_up_to, up_to), (self.arc_next, target.astype(np.int32)),
                         (self.arc_piece, piece.astype(np.int32))):
            store.frombytes(np.ascontiguousarray(x).tobytes())
        self.words.update(zip(new, (base + ends - sizes).tolist()))

    def _bytes_of(self, c: str) -> tuple[int, int]:
        """(mark, how many) of the byte pieces that stand for a character without a piece."""
        if c not in self.marks:
            self.marks[c] = -len(self.byte_first)
            self.byte_pieces.extend(self.bytes[b] for b in c.encode("utf-8", "replace"))
            self.byte_first.append(len(self.byte_pieces))
        mark = self.marks[c]
        return mark, self.byte_first[-mark] - self.byte_first[-1 - mark]

    def ids(self, path: np.ndarray) -> np.ndarray:
        """Piece ids of a path of arcs."""
        return self.ids_all([path])[0]

    def ids_all(self, paths: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of paths of arcs, one behind another, and where each path's begin (one more entry)."""
        at = np.concatenate(([0], np.cumsum([len(p) for p in paths], dtype=np.int64)))
        piece = np.frombuffer(self.arc_piece, np.int32)[np.concatenate(paths)] if paths else np.zeros(0, np.int32)
        marks = np.flatnonzero(piece < 0)
        if not len(marks):
            return piece, at
        first = np.frombuffer(self.byte_first, np.int64)
        own = -1 - piece[marks]
        n = first[own + 1] - first[own]
        size = np.ones(len(piece), np.int64)
        size[marks] = n
        begin = np.concatenate(([0], np.cumsum(size)))
        out = np.repeat(piece, size)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin[marks], n) + step] = np.frombuffer(self.byte_pieces, np.int32)[np.repeat(first[own], n) + step]
        return out, begin[at]

    def decode_all(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The texts of runs of ids."""
        raw = self.raw.take(pa.array(ids, pa.int32()))
        _, where, data = raw.buffers()
        where = np.frombuffer(where, np.int32)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int32)
        data, edges = memoryview(data) if data is not None else b"", where[at].tolist()
        texts = [str(data[a:b], "utf-8", "replace").replace(BLANK, " ") for a, b in zip(edges, edges[1:])]
        return [t[1:] if self.dummy_prefix and t.startswith(" ") else t for t in texts]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.text.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def _backward(pos: np.ndarray, size: np.ndarray, weight: np.ndarray, n: int) -> tuple[list[float], list[float]]:
    """Backward sums of one word of n characters, whose arcs are sorted by the distance of their position to its end:
    (value of each arc, sum at each position)."""
    value, back = [], [0.0] * (n + 1)
    own: list[float] = []
    arcs = list(zip(pos.tolist(), size.tolist(), weight.tolist()))
    for (at, length, w), (after, *_) in zip(arcs, [*arcs[1:], (-1,)]):
        own.append(w + back[at + length])
        if after != at:
            top = max(own)
            back[at] = top + math.log(math.fsum(math.exp(v - top) for v in own))
            value += own
            own = []
    return value, back[:-1]


_SAMPLE = 0xD6E8FEB86659FD93


def _uniform(seed: np.ndarray, sample: int, at: np.ndarray, depth) -> np.ndarray:
    """Numbers in (0, 1) that depend on the arguments alone."""
    salt = np.asarray(depth, np.uint64) + np.asarray(sample * _SAMPLE % (1 << 64), np.uint64)
    x = words.mix(seed ^ words.mix(at.astype(np.uint64) * np.uint64(1 << 20) + salt))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _truncated(mass: np.ndarray, at_most: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values of the given log masses, conditioned to be at most ``at_most``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        v = mass - np.log(np.exp(np.minimum(mass - at_most, 700)) - np.log(u))
    return np.where(np.isneginf(mass), -np.inf, np.minimum(v, at_most))


def _walk(lattice: Lattice, node: np.ndarray, seed: np.ndarray, at: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Random paths from each start node to its word's end: how many arcs each has, and the arcs, path behind path."""
    first, up_to, nxt = (np.frombuffer(x, t) for x, t in ((lattice.node_first, np.int32), (lattice.arc_up_to, np.float64), (lattice.arc_next, np.int32)))
    length = np.zeros(len(node), np.int64)
    steps, alive, depth = [], np.arange(len(node)), 0
    while len(alive) > FEW:
        u = _uniform(seed[alive], sample, at[alive], depth)
        arc = first[node].astype(np.int64)
        more = np.flatnonzero(u > up_to[arc])
        while len(more):
            arc[more] += 1
            more = more[u[more] > up_to[arc[more]]]
        steps.append((alive, arc))
        length[alive] += 1
        node = nxt[arc]
        go = node >= 0
        alive, node, depth = alive[go], node[go], depth + 1
    tails = [_walk_on(lattice, int(n), seed[i], at[i:i + 1], sample, depth) for i, n in zip(alive, node)]
    for i, tail in zip(alive, tails):
        length[i] += len(tail)
    begin = np.cumsum(length) - length
    arcs = np.empty(length.sum(), np.int64)
    for d, (who, arc) in enumerate(steps):
        arcs[begin[who] + d] = arc
    for i, tail in zip(alive, tails):
        arcs[begin[i] + depth:begin[i] + length[i]] = tail
    return length, arcs


def _walk_on(lattice: Lattice, node: int, seed: np.uint64, at: np.ndarray, sample: int, depth: int) -> array:
    """The arcs of one path from ``node`` on."""
    first, up_to, nxt, out = lattice.node_first, lattice.arc_up_to, lattice.arc_next, array("q")
    ahead = 16
    while node >= 0:
        for u in _uniform(seed, sample, at, np.arange(depth, depth + ahead)).tolist():
            arc = first[node]
            while u > up_to[arc]:
                arc += 1
            out.append(arc)
            node = nxt[arc]
            if node < 0:
                break
        depth, ahead = depth + ahead, min(2 * ahead, 4096)
    return out


class _Walk:
    """A sample: its arcs, the word of each, the log mass before each step (and of the whole), and the values left behind."""

    def __init__(self, arcs, unit, value, before, left):
        self.arcs, self.unit, self.value, self.before, self.left = arcs, unit, value, before, left
        self.closed: dict[int, list[int]] = {}

    @property
    def log_prob(self) -> float:
        return float(self.before[-1])


class _Branch:
    """What a text opens next: a walk's first steps and another arc behind them (for the first sample nothing), and the
    value of the best path that goes on from there."""

    def __init__(self, text: int, value: float, walk: _Walk | None = None, step: int = 0, arc: int = -1, node: int = -1, log_p: float = 0.0):
        self.text, self.value, self.node = text, value, node
        if walk is None:
            self.unit, self.kept, self.start = -1, 0, 0.0
            self.arcs, self.units, self.before = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            self.unit, self.kept, self.start = int(walk.unit[step]), step + 1, walk.before[step] + log_p
            self.arcs, self.units, self.before = np.append(walk.arcs[:step], arc), walk.unit[:step + 1], walk.before[:step + 1]


def sample_texts(lattice: Lattice, texts: list[str], seeds: np.ndarray, k: int = SAMPLES) -> list[tuple[list[_Walk], float]]:
    """For each text its k samples (fewer if there are not as many) and kappa."""
    starts = lattice.starts([lattice.units(t) for t in texts])
    arc_p, nxt, first = (np.frombuffer(x, t) for x, t in ((lattice.arc_p, np.float64), (lattice.arc_next, np.int32), (lattice.node_first, np.int32)))
    n_arcs = len(arc_p)
    walks: list[list[_Walk]] = [[] for _ in texts]
    root = _truncated(np.zeros(len(texts)), np.full(len(texts), np.inf), _uniform(seeds, 999, np.zeros(len(texts), np.int64), 0))
    opened = [_Branch(d, float(root[d])) for d in range(len(texts)) if len(starts[d])]
    for sample in range(k):
        if not opened:
            break
        nodes, at = [], []
        for o in opened:
            rest = starts[o.text][o.unit + 1:]
            nodes.append(np.concatenate(([o.node], rest)) if o.node >= 0 else rest)
            at.append(np.arange(o.unit + (o.node < 0), len(starts[o.text])))
        size = np.array([len(x) for x in nodes], np.int64)
        at_all, seed = np.concatenate(at), seeds[[o.text for o in opened]]
        length, arcs = _walk(lattice, np.concatenate(nodes), np.repeat(seed, size), at_all, sample)
        cut = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(size)))]
        unit_of = np.repeat(at_all, length)

        # the new steps of all texts at once: mass before each, and the value of what it leaves behind
        p = arc_p[arcs]
        n = np.diff(cut)
        with np.errstate(divide="ignore"):
            log_p, log_rest = np.log(p), np.log1p(-p)
        sums = []
        for i, o in enumerate(opened):
            run = np.empty(n[i] + 1)
            run[0], run[1:] = o.start, log_p[cut[i]:cut[i + 1]]
            sums.append(np.cumsum(run, out=run))
        step = np.arange(len(arcs)) - np.repeat(cut[:-1] - [o.kept for o in opened], n)
        u = _uniform(np.repeat(seed, n), 1_000 + sample, step, 0)
        left = _truncated(np.concatenate([x[:-1] for x in sums]) + log_rest, np.repeat([o.value for o in opened], n), u)
        for i, o in enumerate(opened):
            new = slice(cut[i], cut[i + 1])
            walks[o.text].append(_Walk(np.concatenate((o.arcs, arcs[new])), np.concatenate((o.units, unit_of[new])), o.value,
                                       np.concatenate((o.before, sums[i])), np.concatenate((np.full(o.kept, -np.inf), left[new]))))
        if sample == k - 1:
            break
        again = []
        for d in (o.text for o in opened):
            w = max(walks[d], key=lambda x: x.left.max(initial=-np.inf))
            value = float(w.left.max(initial=-np.inf))
            if value == -np.inf:
                continue
            step = int(w.left.argmax())
            b = int(np.searchsorted(first, first.dtype.type(w.arcs[step]), side="right"))  # (another type would copy them all)
            a, b = int(first[b - 1]), int(first[b]) if b < len(first) else n_arcs
            closed = w.closed.setdefault(step, [int(w.arcs[step])])
            others = np.array([x for x in range(a, b) if x not in closed], np.int64)
            p = np.cumsum(arc_p[others])
            u = _uniform(seeds[d:d + 1], 2_000 + sample, np.array([step]), len(closed))[0]
            arc = int(others[min(int(np.searchsorted(p, u * p[-1])), len(others) - 1)])
            closed.append(arc)
            rest = math.fsum(arc_p[x] for x in others if x != arc)
            u = _uniform(seeds[d:d + 1], 3_000 + sample, np.array([step]), len(closed))
            with np.errstate(divide="ignore"):
                w.left[step] = _truncated(np.array([w.before[step]]) + np.log(np.array([rest])), np.array([value]), u)[0]
                again.append(_Branch(d, value, w, step, arc, int(nxt[arc]), np.log(arc_p[arc])))
        opened = again
    return [(ws, max((float(w.left.max(initial=-np.inf)) for w in ws), default=-np.inf)) for ws in walks]


def log_inclusion(log_p: float, kappa: float) -> float:
    """log(1 - exp(-exp(log p - kappa))), the chance that a value above kappa was drawn."""
    if kappa == -math.inf:
        return 0.0
    x = log_p - kappa
    return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 700.0))))


def seed_of(doc_ids: pd.Series) -> np.ndarray:
    known = doc_ids.astype("Int64")
    return words.mix(known.fillna(-1).to_numpy(np.int64).view(np.uint64) * np.uint64(2) + known.isna().to_numpy().astype(np.uint64))


def segmentations(docs: DataFrame, model_file: str, k: int = SAMPLES, temperature: float = TEMPERATURE, with_ids: bool = True) -> DataFrame:
    """docs (doc_id, text, ...) -> one row a sample: doc_id, sample (0 is the highest), n_pieces, log_prob, perturbed,
    log_inclusion, ids_crc32 (of little-endian unsigned 32-bit ids), round_trip (the pieces decode to the text), and ids."""
    schema = ("doc_id long, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids_crc32 long, "
              "round_trip boolean" + ", ids array<int>" * with_ids)
    columns = [c.split()[0] for c in schema.split(", ")]
    types = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice.load(model_file, temperature)
        for b in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            ids_of, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            seeds = seed_of(pd.Series(ids_of, dtype="Int64"))
            for part in words.slices(texts, CHARACTERS):
                sampled = sample_texts(lattice, texts[part], seeds[part], k)
                ids, at = lattice.ids_all([w.arcs for walks, _ in sampled for w in walks])
                raw, edges = memoryview(ids.astype("<u4").tobytes()), at.tolist()
                decoded, place = lattice.decode_all(ids, at), 0
                out = []
                for text, doc_id, (walks, kappa) in zip(texts[part], ids_of[part], sampled):
                    text = text.replace(BLANK, " ")
                    for i, w in enumerate(walks):
                        x, y = edges[place:place + 2]
                        out.append((doc_id, i, y - x, w.log_prob, w.value, log_inclusion(w.log_prob, kappa), zlib.crc32(raw[4 * x:4 * y]),
                                    decoded[place] == text))
                        place += 1
                if out:
                    arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                    lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))] if with_ids else []
                    yield pa.RecordBatch.from_arrays(arrays + lists, columns)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
