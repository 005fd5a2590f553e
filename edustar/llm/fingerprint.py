"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the k smallest distinct 64-bit hashes of a text's five-word shingles (white-space words, lower
case). Sketches of parts merge by keeping the k smallest of their union, and estimate resemblance,
containment and the number of distinct shingles.

Defined cases: a null text counts as empty; an empty text has the empty sketch; a text of one to four
words has one shingle; two empty sketches resemble each other by 1, an empty and a full one by 0; rows
with the same doc_id are ordered by their text; a null doc_id comes after all others.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edustar.llm import words

SHINGLE = 5
K = 128

#: Buckets of the order by doc_id: a bound on the boundaries that the driver holds, and rows in a bucket.
MAX_BUCKETS = 4096
BUCKET_ROWS = 1000


# -- sketches -----------------------------------------------------------------------------------------

def sketches(texts, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted bottom-k sketch of each text."""
    out: list[np.ndarray] = []
    for part in words.slices(texts):
        h, first = words.shingle_hashes(*words.word_hashes(texts[part]), shingle)
        out += [_bottom(h[a:b], k) for a, b in zip(first[:-1], first[1:])]
    return out


def _bottom(h: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distinct values, in order."""
    take = 2 * k
    while len(h) > take:
        low = np.unique(np.partition(h, take)[:take])
        if len(low) >= k:
            return low[:k]
        take *= 4
    return np.unique(h)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of two parts' union, from their sketches."""
    return np.union1d(a, b)[:k]


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / (float(a[k - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness; exact while both hold all their shingles."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:k]
    shared = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(shared, both[-1], side="right")) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    return min(1.0, j * distinct_count(merge(a, b, k), k) / distinct_count(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, fingerprint, n_shingles (estimated distinct shingles)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = sketches(b["text"].tolist(), k)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "fingerprint": [to_text(a) for a in found],
                                "n_shingles": [distinct_count(a, k) for a in found]})
    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fingerprint string, n_shingles double")


# -- the next document --------------------------------------------------------------------------------

def with_next_text(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the next row's text by descending doc_id, cyclic; null texts are empty.

    Documents are cut into ranges of doc_id at quantiles; each range is ordered in its own window. The
    first row of a range is also given, as a ghost, to the end of the range before it, so no row needs a
    global order. The driver holds one number for each range, MAX_BUCKETS at most.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = docs.count()
    buckets = max(1, min(MAX_BUCKETS, -(-n // BUCKET_ROWS)))
    at = [i / buckets for i in range(1, buckets)]
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("long"), at, 20 * buckets)).first()[0] if at else []
    cuts = sorted({int(c) for c in cuts or []})
    # bucket 0 has the largest ids; a null id is in the last one
    edges = F.array(*[F.lit(c) for c in cuts]) if cuts else None
    bucket = F.lit(len(cuts)) - _search(edges, F.col("doc_id"), len(cuts)) if cuts else F.lit(0)
    bucket = F.coalesce(bucket, F.lit(len(cuts))).cast("int")
    rows = rows.withColumn("bucket", bucket)

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).withColumn("bucket", bucket)
    heads = sorted(ids.groupBy("bucket").agg(F.max("doc_id")).collect())  # a row for each range
    if not heads:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    ghost = docs.sparkSession.createDataFrame(
        [(heads[i - 1][0], heads[i][1]) for i in range(len(heads))], "before int, head long")
    ghosts = rows.join(F.broadcast(ghost), F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", F.col("before").alias("bucket"), F.lit(True).alias("ghost"))
    order = [F.col("ghost"), F.col("doc_id").desc_nulls_last(), F.col("text")]
    w = Window.partitionBy("bucket").orderBy(*order)
    return (rows.withColumn("ghost", F.lit(False)).unionByName(ghosts)
            .withColumn("next_text", F.lead("text").over(w)).where("not ghost")
            .select("doc_id", "text", "next_text"))


def _search(edges, x, n: int):
    """How many of the n sorted edges are <= x, by bisection in one column expression."""
    low, high = F.lit(0), F.lit(n)
    state = F.struct(low.alias("lo"), high.alias("hi"))

    def step(s, _):
        mid = ((s["lo"] + s["hi"]) / 2).cast("int")
        done = s["lo"] >= s["hi"]
        right = F.get(edges, mid) <= x
        return F.struct(F.when(done | ~right, s["lo"]).otherwise(mid + 1).alias("lo"),
                        F.when(done | right, s["hi"]).otherwise(mid).alias("hi"))

    turns = max(1, n.bit_length() + 1)
    return F.when(x.isNotNull(), F.aggregate(F.array_repeat(F.lit(0), turns), state, step)["lo"])


def edited(text: str, following: str) -> str:
    """The last third of the text (in code points, rounded down) replaced by the following text's beginning
    of the same length, or all of it."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def edit_likeness(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are and the next text is."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, nexts = b["text"].tolist(), b["next_text"].tolist()
            for part in words.slices(texts, 1 << 20):
                t, nx = texts[part], nexts[part]
                e = [edited(x, y) for x, y in zip(t, nx)]
                own, ed = sketches(t, k), sketches(e, k)
                same = [x == y for x, y in zip(nx[:-1], t[1:])]
                other = sketches([x for x, s in zip(nx, [*same, False]) if not s], k)
                it = iter(other)
                follow = [own[i + 1] if s else next(it) for i, s in enumerate([*same, False])]
                yield pd.DataFrame({
                    "doc_id": b["doc_id"].iloc[part].astype("Int64"), "n_chars": [len(x) for x in t],
                    "edited_sha256": [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in e],
                    "fingerprint": [to_text(a) for a in own], "edited_fingerprint": [to_text(a) for a in ed],
                    "near_edited": [resemblance(a, x, k) for a, x in zip(own, ed)],
                    "near_next": [resemblance(a, x, k) for a, x in zip(own, follow)],
                    "n_shingles": [distinct_count(a, k) for a in own],
                    "edited_containment": [containment(a, x, k) for a, x in zip(own, ed)]})
    return with_next_text(docs).mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, n_shingles double, edited_containment double")
