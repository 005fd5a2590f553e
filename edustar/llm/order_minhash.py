"""Near-duplicate documents by order MinHash, verified by banded alignment.

Two texts are near copies when the edit similarity of their word sequences (white-space words, lower case) is SIMILARITY or more:
1 - edits / words of the longer one. Order MinHash finds candidates among texts of similarity * SHORT words or more: for
each of SKETCHES hash functions, the DEPTH smallest occurrence-labelled K-word k-mers, kept in text order, are one
signature, so a signature is sensitive to what a text holds and in which order. K, SKETCHES and DEPTH follow from the recall
wanted at the similarity itself: edits scattered at random at 0.8 leave a resemblance of about 0.47 of word pairs, so a
pair is missed with (1 - 0.47**3)**48, about 0.5%; edits evenly apart, the worst case, leave 0.43 (2%). Texts of up to SHORT words have too
few k-mers for that: they meet by the rarest of their word pairs, as many as the similarity asks for (prefix), which
misses no pair at all. Two linked texts have lengths within the similarity, so either both have SHORT words at most or both are sketched.

1. Equal texts form one class, counted with a map-side combine; only classes go on.
2. Classes that share a signature or a rare pair form buckets. Every bucket's smallest member is its pivot; each other member is aligned with it (a star:
   a bucket of thousands costs thousands of alignments, not millions). Pairs that recur in several buckets
   are aligned once. Linked classes join into components.
3. Members that are not in their pivot's component are still to be compared with each other and, where the
   triangle inequality allows a link to one of the pivot's partners, with the whole bucket. This is done in
   blocks of about BLOCK members and BLOCK_WORDS words, two blocks at a time, within a task. There an index of word
   pairs (prefix_partners) finds the partners that the similarity allows at all; a pair already joined is skipped,
   and so is one that lengths, shared words or pivot distances rule out. So no candidate is left out, however
   large its bucket.
4. Components of all links are the classes that the result names.

Texts travel as 32-bit word numbers and only for classes that share a bucket. A collision of 64-bit hashes (of texts) would
join two texts by mistake: about n**2 / 2**65 for n texts.

Defined cases: a null text counts as empty; a text of one word has two pairs, with its start and its end; empty
texts are equal to each other and to nothing else; repeated rows are equal texts; a null doc_id gets its class's smallest
doc_id and is never kept unless its class has none; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edustar.llm import words
from edustar.llm.components import components
from edustar.llm.store import stored

K, SKETCHES, DEPTH = 2, 48, 3
SIMILARITY = 0.8
#: Up to so many words, texts meet by their rarest word pairs.
SHORT = 100
#: Bits of the table of how common word pairs of short texts are; it is collected, and only orders them.
COMMON_BITS = 18
#: Members and words of a block that one task compares with another block.
BLOCK, BLOCK_WORDS = 1_024, 1 << 20


# -- signatures ---------------------------------------------------------------------------------------

def _labelled(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """k-mer hashes labelled by how often the same k-mer occurred before in the same text."""
    if not len(h):
        return h
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    start = np.flatnonzero(new)
    rank = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
    out = h.copy()
    again = rank > 0
    out[order[again]] = words.mix(h[order[again]] + rank[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def signatures(h: np.ndarray, first: np.ndarray, sketches: int = SKETCHES, depth: int = DEPTH) -> np.ndarray:
    """(texts with k-mers..., sketches) signatures; 0 for texts without k-mers."""
    n = np.diff(first)
    out = np.zeros((len(n), sketches), np.int64)
    full = np.flatnonzero(n > 0)
    if not len(full):
        return out
    labelled = _labelled(h, first)
    starts, sizes = first[:-1][full], n[full]
    owner = np.repeat(np.arange(len(full)), sizes)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for r in range(sketches):
        v = words.mix(labelled ^ words.mix(np.array([r + 1], np.uint64)))
        where = np.full((len(full), depth), -1, np.int64)
        for d in range(depth):
            least = np.minimum.reduceat(v, starts)
            hit = np.flatnonzero((v == least[owner]) & (least[owner] != top))
            who, at = np.unique(owner[hit], return_index=True)
            where[who, d] = hit[at]
            v[hit[at]] = top
        where.sort(axis=1)  # text order; missing ones (-1) first
        s = np.zeros(len(full), np.uint64)
        for d in range(depth):
            term = np.where(where[:, d] >= 0, labelled[np.maximum(where[:, d], 0)], np.uint64(0))
            s = words.mix(s * np.uint64(31) + term + np.uint64(d + 1))
        out[full, r] = s.view(np.int64)
    return out


def neighbour_pairs(w: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled hashes of each text's pairs of neighbours, both ends included, and each text's first pair."""
    n = np.diff(first)
    doc = np.arange(len(n))
    padded = np.full(len(w) + 2 * len(n), 1 << 32, np.uint64)
    padded[first[1:] + 2 * doc + 1] += np.uint64(1)
    padded[np.arange(len(w)) + 2 * np.repeat(doc, n) + 1] = w
    out_first = np.concatenate(([0], np.cumsum(n + 1)))
    at = np.arange(out_first[-1]) + np.repeat(doc, n + 1)  # every text before holds one word more than pairs
    return _labelled(words.mix(padded[at] * np.uint64(0x9E3779B97F4A7C15) + padded[at + 1]), out_first), out_first


def prefix_size(n: np.ndarray, similarity: float) -> np.ndarray:
    """How many of their pairs texts of n words must show, in an order common to all, so that near ones meet (see prefix_partners)."""
    return np.minimum(n + 2 - np.ceil((2 * similarity - 1) * n + 1 - 1e-6).astype(np.int64), n + 1)


def common_slot(pairs: np.ndarray) -> np.ndarray:
    """A pair's place in the table of how common pairs are."""
    return (pairs.astype(np.int64, copy=False).view(np.uint64) >> np.uint64(64 - COMMON_BITS)).astype(np.int64)


def prefix(pairs: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """Of one text's pairs the rarest, as many as the similarity asks for."""
    return pairs[np.lexsort((pairs, common[common_slot(pairs)]))[:int(prefix_size(np.array([len(pairs) - 1]), similarity)[0])]]


# -- alignment ----------------------------------------------------------------------------------------

def banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two number sequences, or limit + 1 if it is more. Common ends are trimmed; the rest is
    aligned within the diagonal band of half-width ``limit``, one bit a diagonal (bit-vector dynamic programming)."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return limit + 1
    m = len(b)
    if m:
        differ = np.flatnonzero(a[:m] != b)
        if not len(differ):
            return len(a) - m
        a, b = a[differ[0]:], b[differ[0]:]
        m = len(b)
        differ = np.flatnonzero(a[len(a) - m:][::-1] != b[::-1])
        cut = int(differ[0]) if len(differ) else m
        a, b = a[:len(a) - cut], b[:m - cut]
    if not len(b):
        return len(a) if len(a) <= limit else limit + 1
    if limit < 1:
        return limit + 1  # both still hold words, so they differ
    beyond, limit = limit + 1, min(limit, len(a))
    at: dict[int, int] = {}
    for i, x in enumerate(b.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    # Rows are b; columns are a. The band of column j holds rows j-limit .. j+limit; bit k is row j-limit+k.
    n, m, width = len(a), len(b), 2 * limit + 1
    mask = (1 << width) - 1
    # before column 0: rows below 0 cost nothing extra; going down costs one a row
    plus, minus = mask & ~((1 << limit) - 1), 0
    score, diagonal = 0, 1 << limit  # the cost on the main diagonal cell of each column
    last = m - 1
    for j, x in enumerate(a.tolist()):
        low = j - limit
        eq = at.get(x, 0)
        eq = (eq >> low if low >= 0 else eq << -low) & mask
        d0 = ((((eq & plus) + plus) ^ plus) | eq | minus) & mask
        hp = minus | (mask & ~(d0 | plus))
        hn = d0 & plus
        if j <= last:
            score += not d0 & diagonal
        else:  # below the last row the path runs along row ``last``: its bit in this column's band
            k = last - low
            score += (hp >> k & 1) - (hn >> k & 1)
        # the score never falls along the diagonal, and by one at most for each later column
        if score > limit + (n - m if j <= last else n - j - 1):
            return beyond
        down = d0 >> 1
        plus = (hn | (mask & ~(down | hp))) & mask
        minus = down & hp
    return score if score <= limit else beyond


def allowed_edits(longer: int, similarity: float = SIMILARITY) -> int:
    """The most edits at which similarity is still reached."""
    return int(np.floor((1.0 - similarity) * longer + 1e-9))


def near_edits(longer: int, similarity: float = SIMILARITY) -> int:
    """Beyond so many edits from its pivot, a text is linked to none that is linked to the pivot (triangle
    inequality; a linked text is longer by 1 / similarity at most)."""
    return int(np.floor(2 * (1.0 - similarity) / similarity * longer + 1e-9)) + 2


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the bags' intersection of two sorted sequences, or a little more."""
    ua, na = np.unique(a, return_counts=True)
    ub, nb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    return int(np.minimum(na[ia], nb[ib]).sum())


def edits_within(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """banded_distance behind two cheap lower bounds (lengths, shared words)."""
    longer = max(len(a), len(b))
    if longer - min(len(a), len(b)) > limit or longer - _shared(a, b) > limit:
        return limit + 1
    return banded_distance(a, b, limit)


def prefix_partners(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> Iterator[np.ndarray]:
    """For each left sequence, the places in ``right`` of all that can reach the similarity, and of few others.

    A sequence of n words has n + 1 pairs of neighbours, both ends included, and an edit changes two of them at most. So two
    sequences within the similarity share (2 * similarity - 1) * n + 1 pairs or more, and if each side's pairs stand
    in one common order, rarest first, they meet in the first n + 2 minus that many. Only those are indexed."""
    if similarity <= 0.5 or not left or not right:
        for _ in left:
            yield np.arange(len(right))
        return
    n = np.array([len(x) for x in left + right])
    pairs, first = neighbour_pairs(np.concatenate(left + right).astype(np.uint64), np.concatenate(([0], np.cumsum(n))))
    owner = np.repeat(np.arange(len(n)), n + 1)
    _, token, count = np.unique(pairs, return_inverse=True, return_counts=True)
    token = token[np.lexsort((token, count[token], owner))]
    kept = np.arange(first[-1]) - first[owner] < prefix_size(n, similarity)[owner]
    token, owner = token[kept], owner[kept]
    own = owner >= len(left)
    order = np.argsort(token[own], kind="stable")
    sorted_tokens, places = token[own][order], owner[own][order] - len(left)
    low, high = np.searchsorted(sorted_tokens, token[~own]), np.searchsorted(sorted_tokens, token[~own], side="right")
    cut = np.searchsorted(owner[~own], np.arange(len(left) + 1))
    for x, y in zip(cut[:-1], cut[1:]):
        yield np.unique(np.concatenate([places[a:b] for a, b in zip(low[x:y], high[x:y])]))


# -- the job ------------------------------------------------------------------------------------------

def _classes(docs: DataFrame) -> DataFrame:
    """doc_id and the 64-bit number of its text for every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))


def _sketch(rows: DataFrame, similarity: float, sketches: int, depth: int) -> DataFrame:
    """node, n_words, sigs (of texts that order MinHash finds) and pairs (of short texts) of every row (equal texts repeat)."""
    none = np.zeros(0, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for part in words.slices(texts):
                w, first = words.word_hashes(texts[part])
                n = np.diff(first)
                s = signatures(*words.shingle_hashes(w, first, K), sketches, depth)
                sigs = [x if m >= similarity * SHORT else none for x, m in zip(s, n.tolist())]
                short = n <= SHORT
                pairs, cut = neighbour_pairs(w[np.repeat(short, n)], np.concatenate(([0], np.cumsum(n[short]))))
                pairs = iter(np.split(pairs.view(np.int64), cut[1:-1]))
                yield pd.DataFrame({"doc_id": b["doc_id"].iloc[part].astype("Int64").values, "node": b["node"].iloc[part].values, "n_words": n, "sigs": sigs,
                                    "pairs": [next(pairs) if m and x else none for m, x in zip(short.tolist(), n.tolist())]})
    return rows.mapInPandas(run, "doc_id long, node long, n_words int, sigs array<long>, pairs array<long>")


def _rare(classes: DataFrame, similarity: float) -> DataFrame:
    """node, n_words, bucket: the short texts' rarest pairs."""
    slot = F.shiftrightunsigned("pair", 64 - COMMON_BITS)
    counts = classes.select(F.explode("pairs").alias("pair")).groupBy(slot.alias("slot")).count().collect()  # 2^COMMON_BITS rows at most
    common = np.zeros(1 << COMMON_BITS, np.int64)
    for slot, count in counts:
        common[slot] = count
    common = classes.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(pairs=[prefix(x, common.value, similarity) for x in b["pairs"]])
    kept = classes.where(F.size("pairs") > 0).select("node", "n_words", "pairs").mapInPandas(run, "node long, n_words int, pairs array<long>")
    return kept.select("node", "n_words", F.explode("pairs").alias("pair")).select(F.xxhash64("pair").alias("bucket"), "node", "n_words")


def _sequences(rows: DataFrame) -> DataFrame:
    """node and its words as 32-bit numbers."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for part in words.slices(texts):
                w, first = words.word_hashes(texts[part])
                w = (w >> np.uint64(32)).astype("<u4")
                yield pd.DataFrame({"node": b["node"].iloc[part].values, "seq": [w[x:y].tobytes() for x, y in zip(first[:-1], first[1:])]})
    return rows.select("node", "text").mapInPandas(run, "node long, seq binary")


def _seq(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4")


def links(docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, depth: int = DEPTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: doc_id, node; classes: node, doc_id, copies; joined: node, component of linked classes)."""
    rows = _classes(docs)
    sketched = stored(_sketch(rows, similarity, sketches, depth), "sketches")
    classes = stored(sketched.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("sigs").alias("sigs"), F.first("pairs").alias("pairs")), "classes")

    # buckets: (sketch, signature) or rare pair -> members; only those shared by two classes or more
    keyed = classes.where("n_words > 0").select("node", "n_words", F.posexplode("sigs").alias("r", "sig")).withColumn(
        "bucket", F.xxhash64("r", "sig")).select("bucket", "node", "n_words").union(_rare(classes, similarity))
    heads = keyed.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).where("size > 1")
    in_buckets = stored(keyed.join(heads, "bucket"), "buckets")

    # one row a class, that of its smallest doc_id: with it in the key, the copies of one text spread over many tasks
    known = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id")
    wanted = classes.join(in_buckets.select("node").distinct(), "node", "left_semi").select("node", known)
    sequences = stored(_sequences(rows.select("node", known, "text").join(wanted, ["node", "id"], "left_semi").dropDuplicates(["node"])), "sequences")

    star = in_buckets.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    sides = [sequences.select(F.col("node").alias(k), F.col("seq").alias(f"{k}_seq")) for k in "ab"]

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for x, y in zip(p["a_seq"], p["b_seq"]):
                x, y = _seq(x), _seq(y)
                longer = max(len(x), len(y))
                near = near_edits(longer, similarity)
                edits = edits_within(x, y, near)
                out.append((edits, edits <= allowed_edits(longer, similarity), edits <= near))
            got = pd.DataFrame(out, columns=["edits", "linked", "near"])
            yield pd.DataFrame({"a": p["a"].values, "b": p["b"].values}).join(got)
    aligned = stored(star.join(sides[0], "a").join(sides[1], "b").mapInPandas(
        align, "a long, b long, edits long, linked boolean, near boolean"), "stars")

    first = stored(components(aligned.where("linked").select("a", "b")), "first_components")
    of = lambda k, name: first.select(F.col("node").alias(k), F.col("component").alias(name))
    star_of = aligned.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "edits", "linked", "near")
    members = (in_buckets.select("bucket", "node", "pivot", "n_words").join(of("node", "c"), "node", "left").join(of("pivot", "pc"), "pivot", "left")
               .join(star_of, ["pivot", "node"], "left")  # a pivot has no row with itself
               .select("bucket", "node", "n_words", F.coalesce("c", "node").alias("c"), F.coalesce("edits", F.lit(0)).alias("edits"),
                       F.coalesce("linked", F.lit(True)).alias("linked"), F.coalesce("near", F.lit(True)).alias("near"),
                       (F.coalesce("c", "node") != F.coalesce("pc", "pivot")).alias("apart")))
    members = stored(members, "members")
    # with whom the members apart are to be compared: each other, or the whole bucket
    left = members.groupBy("bucket").agg(
        F.sum(F.col("apart").cast("long")).alias("n_apart"), F.count("*").alias("n"),
        F.sum(F.when(F.col("apart"), F.col("n_words")).otherwise(0)).alias("words_apart"), F.sum("n_words").alias("words"),
        F.max((F.col("apart") & F.col("near")) | (~F.col("apart") & ~F.col("linked"))).alias("all")).where("n_apart > 1 or n_apart = 1 and all")
    blocks = lambda n, size: F.ceil(F.greatest(F.col(n) / BLOCK, F.col(size) / BLOCK_WORDS)).cast("int")
    apart = blocks("n_apart", "words_apart")
    rest = members.join(left, "bucket").withColumn("ni", apart).withColumn("nj", F.when(F.col("all"), blocks("n", "words")).otherwise(apart))
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = ["node", "c", "edits", "near", "apart"]
    pairs = rest.where("apart").select("bucket", mine("ni").alias("i"), every("nj").alias("j"), F.lit(True).alias("asks"), *keep).union(
        rest.where("apart or all").select("bucket", every("ni").alias("i"), mine("nj").alias("j"), F.lit(False).alias("asks"), *keep))

    def compare(b: pd.DataFrame) -> pd.DataFrame:
        asks, own = b[b["asks"]].sort_values("node"), b[~b["asks"]].sort_values("node")
        left, right = ([_seq(x) for x in side["seq"]] for side in (asks, own))
        sizes = np.array([len(x) for x in right])
        nodes, edits, near, apart = (own[k].to_numpy() for k in ("node", "edits", "near", "apart"))
        mine, theirs = asks["c"].to_numpy().copy(), own["c"].to_numpy().copy()  # components, joined as links are found
        out = []
        for i, (r, k) in enumerate(zip(asks.itertuples(), prefix_partners(left, right, similarity))):
            longer = np.maximum(sizes[k], len(left[i]))
            limit = np.floor((1.0 - similarity) * longer + 1e-9)
            open_ = (longer - np.minimum(sizes[k], len(left[i])) <= limit) & ~(apart[k] & (nodes[k] <= r.node))
            if r.near:
                open_ &= ~(near[k] & (np.abs(edits[k] - r.edits) > limit))
            for j, most in zip(k[open_].tolist(), limit[open_].astype(int).tolist()):
                if mine[i] != theirs[j] and edits_within(left[i], right[j], most) <= most:
                    old = theirs[j]
                    mine[mine == old] = mine[i]
                    theirs[theirs == old] = mine[i]
                    out.append((r.node, nodes[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    more = pairs.join(sequences, "node").groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long")
    more = stored(more, "more_links")
    joined = components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    return sketched.select("doc_id", "node"), classes, stored(joined, "components")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, depth: int = DEPTH) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, class_id (smallest doc_id of the class), n_copies (rows with this
    text), class_rows, kept (doc_id = class_id) for every row."""
    rows, named = _named(*links(docs, similarity, sketches, depth))
    return rows.join(named.drop("doc_id"), "node").select("doc_id", "class_id", "n_copies", "class_rows",
                                           F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept"))


def _named(rows: DataFrame, classes: DataFrame, joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    comp = classes.join(joined, "node", "left").select("node", "doc_id", F.col("copies").alias("n_copies"), F.coalesce("component", "node").alias("component"))
    comp = stored(comp, "class_components")
    total = comp.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.sum("n_copies").alias("class_rows"))
    return rows, stored(comp.join(total, "component"), "classes_named")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows, all columns kept, with one row of each class: its smallest doc_id's, one of them if that repeats."""
    _, named = _named(*links(docs, similarity))
    least = F.lit(-(1 << 63))
    best = named.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("component").agg(
        F.min("node").alias("__node"), F.coalesce(F.min("doc_id"), least).alias("__id"))
    best = stored(best.select("__node", "__id"), "kept")
    marked = docs.withColumn("__node", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), least))
    w = Window.partitionBy("__node", "__id").orderBy("__node")
    return marked.join(best, ["__node", "__id"], "left_semi").withColumn("__row", F.row_number().over(w)).where("__row = 1").select(
        *[F.col(f"`{c}`") for c in docs.columns])
