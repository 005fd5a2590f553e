"""Hard-negative mining by coordinate pruning in length buckets (after LEMP).

1. Every usable row's components become integers; rows are numbered by vector length over the whole table and cut
   into buckets of equal bytes, so a bucket holds vectors of like length (rows of one length, however many, are
   split by their id). Within a task a bucket keeps, for each coordinate, its rows sorted by the unit vectors' value.
2. An anchor that wants scores of ``t`` or more needs a cosine of t / (its length x the bucket's longest) there. A bucket
   where that is over 1 is skipped. For the anchor's ``FOCUS`` largest coordinates, the cosine confines the other vector's
   value to a range (the rest of both vectors can add no more than their lengths): the narrowest range is read
   from its sorted list, the others intersect it, and what is left is verified by the exact integer product.
3. Positives: the bucket of the longest rows gives each anchor a first ``t`` (its 5th best row there); the other
   buckets are searched with that. Negatives: ``t`` is the least score that a positive allows.
4. A bucket returns the best few for each anchor (and positive) only; windows over the anchor merge the buckets'.

Rows go to their bucket's task once; anchors are streamed through it in batches behind the rows, so a task holds
one bucket and one batch. Anchors are sent once to every bucket that their length lets them need.

Defined cases: rows with a null vec_id, label or vector or with a null or non-finite component take no part; of rows
with one vec_id the greatest (label, vector) takes part; vectors of unlike length are compared as if the shorter
had zeros behind it, an empty vector as zeros; ties go to the smaller vec_id; an anchor without positives and a
positive without negatives (as any with a negative score) give no rows; an empty table gives an empty result;
other columns are not read. Products are exact: in double precision as long as no sum can pass 2^53, else in
Python integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edustar.llm.store import stored
from edustar.operators.ranking import numbered

POSITIVES = NEGATIVES = 5
#: A negative's score lies between this share (per cent) of the positive's and the positive's.
LEAST_PERCENT = 80
SCALE = 256
#: Bytes of a bucket's vectors in double precision.
BUCKET_BYTES = 8 << 20
FOCUS = 4
#: Buckets are joined into so many ranges at most whose greatest lengths are told to the anchors.
RANGES = 64
_EXACT = float(1 << 53)

Found = tuple[np.ndarray, np.ndarray]


def _pack(v, dim: int) -> bytes | None:
    """floor(SCALE * x) of each component, zeros behind; None if the vector is not usable."""
    x = np.array([np.nan if c is None else c for c in v], np.float64)
    with np.errstate(over="ignore"):
        x = np.floor(x * SCALE)
    if not np.isfinite(x).all():
        return None
    x = np.concatenate((x, np.zeros(dim - len(x))))
    return (x.astype(np.int32) if len(x) == 0 or np.abs(x).max() < 1 << 31 else x).tobytes()


def _unpack(packed: pd.Series, dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(b, np.int32 if len(b) == 4 * dim else np.float64).astype(np.float64) for b in packed]) if len(packed) else np.zeros((0, dim))


class Bucket:
    """Rows of like length with the sorted lists of their coordinates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.length = np.sqrt((x * x).sum(axis=1))
        self.longest = float(self.length.max(initial=0.0))
        self.size = float(np.abs(x).max(initial=0.0))
        self.unit = np.ascontiguousarray((x / np.where(self.length > 0, self.length, 1.0)[:, None]).T)
        self.order = np.argsort(self.unit, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.unit, self.order, axis=1)

    def candidates(self, q: np.ndarray, length: float, at_least: float | None, focus: int = FOCUS) -> np.ndarray:
        """Rows that can have a product of ``at_least`` (> 0) with q; all rows without such a bound."""
        if at_least is None or at_least <= 0:
            return np.arange(len(self.ids))
        need = at_least / max(length * self.longest, 1e-300)
        if need > 1 + 1e-9:
            return np.zeros(0, np.int64)
        spread = np.arccos(min(need, 1.0))
        unit = q / length
        best = np.argpartition(-np.abs(unit), min(focus, len(unit)) - 1)[:focus]
        angle = np.arccos(np.clip(unit[best], -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, angle + spread)) - 1e-9
        high = np.cos(np.maximum(0.0, angle - spread)) + 1e-9
        edges = [(np.searchsorted(self.sorted[f], a), np.searchsorted(self.sorted[f], b, "right")) for f, a, b in zip(best, low, high)]
        least = min(range(len(best)), key=lambda i: edges[i][1] - edges[i][0])
        rows = self.order[best[least], edges[least][0]:edges[least][1]]
        for i, f in enumerate(best):
            if i != least and len(rows):
                value = self.unit[f, rows]
                rows = rows[(value >= low[i]) & (value <= high[i])]
        return rows[self.length[rows] * length >= at_least * (1 - 1e-9)]

    def products(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact integer products."""
        if self.size * float(np.abs(q).max(initial=0.0)) * len(q) < _EXACT:
            return (self.x[rows] @ q).astype(np.int64)
        whole = lambda a: np.array([int(c) for c in a.ravel()], object).reshape(a.shape)
        return whole(self.x[rows]) @ whole(q) if len(rows) else np.zeros(0, np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(ids) > 4 * k:
        floor = np.partition(scores, -k)[-k]
        some = np.flatnonzero(scores >= floor)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def positives_in(bucket: Bucket, vec_id: int, q: np.ndarray, at_least: int | None, k: int) -> Found:
    """The best k rows of a bucket of one label, the anchor itself left out: (ids, scores)."""
    rows = bucket.candidates(q, float(np.sqrt(q @ q)), at_least)
    rows = rows[bucket.ids[rows] != vec_id]
    scores = bucket.products(rows, q)
    top = best(bucket.ids[rows], scores, k)
    return bucket.ids[rows][top], scores[top]


def least_allowed(positive: int) -> int:
    """The least negative score beside a positive's."""
    return -(-LEAST_PERCENT * positive // 100)


def negatives_in(bucket: Bucket, label: int, q: np.ndarray, positives: list[int], k: int) -> Iterator[Found]:
    """For each positive score (>= 0) the best k rows of other labels that it allows: (ids, scores)."""
    rows = bucket.candidates(q, float(np.sqrt(q @ q)), min(least_allowed(p) for p in positives))
    rows = rows[bucket.labels[rows] != label]
    scores = bucket.products(rows, q)
    for p in positives:
        ok = np.flatnonzero((scores >= least_allowed(p)) & (scores <= p))
        top = ok[best(bucket.ids[rows[ok]], scores[ok], k)]
        yield bucket.ids[rows[top]], scores[top]


def usable_rows(vectors: DataFrame, dim: int) -> DataFrame:
    """vectors (vec_id, embedding, label, ...) -> vec_id, label (shifted), packed, length: one row for each vec_id."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            packed = [_pack(v, dim) for v in b["embedding"]]
            got = pd.DataFrame({"vec_id": b["vec_id"], "label": b["label"], "packed": packed})[[p is not None for p in packed]]
            x = _unpack(got["packed"], dim)
            got["length"] = np.sqrt((x * x).sum(axis=1))
            yield got
    some = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(
        "vec_id is not null and label is not null and embedding is not null")
    some = some.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    rows = some.mapInPandas(run, "vec_id long, label long, packed binary, length double")
    return rows.groupBy("vec_id").agg(F.max(F.struct("label", "packed", "length")).alias("r")).select("vec_id", "r.*")


def _searched(buckets: DataFrame, anchors: DataFrame, n_buckets: int, dim: int, find, schema: str) -> DataFrame:
    """Each bucket's rows, then the anchors sent to it, through one task; ``find(bucket rows, anchors)`` gives frames."""
    rows = buckets.select("bucket", F.lit(0).alias("kind"), "vec_id", "label", "packed", F.lit(None).cast("array<long>").alias("wanted"))
    sent = anchors.select("bucket", F.lit(1).alias("kind"), "vec_id", "label", "packed", "wanted")
    both = rows.unionByName(sent).repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "kind")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held, index = None, [], {}
        for b in batches:
            for bucket, part in b.groupby("bucket", sort=True):
                if bucket != number:
                    number, held, index = bucket, [], {}
                own = part[part["kind"] == 0]
                if len(own):
                    held.append((own["vec_id"].to_numpy(np.int64), own["label"].to_numpy(np.int64), _unpack(own["packed"], dim)))
                asks = part[part["kind"] == 1]
                if len(asks) and held:
                    yield from find(held, index, asks)
    return both.mapInPandas(run, schema)


def _joined(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(held) > 1:
        held[:] = [tuple(np.concatenate(c) for c in zip(*held))]
    return held[0]


def _first(partition: list[str], k: int, df: DataFrame) -> DataFrame:
    order = Window.partitionBy(*partition).orderBy(F.desc("score"), F.asc("other_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """vectors (vec_id, embedding, label, ...) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    Anchors are the rows whose vec_id is divisible by ``every``."""
    dim = max(int(vectors.agg(F.max(F.size("embedding"))).first()[0] or 0), 1)
    per = max(1, bucket_bytes // (8 * dim))
    rows = numbered(usable_rows(vectors, dim), [F.asc("length"), F.asc("vec_id")], "number")
    rows = stored(rows.withColumn("bucket", F.floor(F.col("number") / per).cast("int")).drop("number"), "buckets")
    n_buckets = (rows.agg(F.max("bucket")).first()[0] or 0) + 1
    width = -(-n_buckets // RANGES)
    ranges = {r["range"]: r["longest"] for r in rows.groupBy(F.floor(F.col("bucket") / width).alias("range")).agg(
        F.max("length").alias("longest")).collect()}  # RANGES rows at most
    reach = F.array(*[F.lit(float(ranges.get(i, 0.0))) for i in range(-(-n_buckets // width))])
    anchors = rows.where(F.col("vec_id") % every == 0).select("vec_id", "label", "packed", "length")

    def sent(df: DataFrame, to: Column) -> DataFrame:
        return df.withColumn("bucket", F.explode(to)).select("bucket", "vec_id", "label", "packed", "wanted")

    def needed(at_least: Column, last: int) -> Column:
        """The buckets up to ``last`` that an anchor's length does not rule out."""
        within = F.filter(F.sequence(F.lit(0), F.lit(len(ranges) - 1)), lambda r: at_least.isNull() | (at_least <= 0)
                          | (F.col("length") * F.get(reach, r) >= at_least * (1 - 1e-9)))
        of_range = F.transform(within, lambda r: F.sequence(r * width, r * width + (width - 1)))
        return F.filter(F.flatten(of_range), lambda b: b <= last)

    def find_positives(held, index, asks):
        ids, labels, x = _joined(held)
        out = []
        for a in asks.itertuples(index=False):
            if a.label not in index:
                own = labels == a.label
                index[a.label] = Bucket(ids[own], labels[own], x[own]) if own.any() else None
            if index[a.label] is not None:
                q = _unpack(pd.Series([a.packed]), dim)[0]
                wanted = None if a.wanted is None or len(a.wanted) == 0 else int(a.wanted[0])
                got, scores = positives_in(index[a.label], a.vec_id, q, wanted, positives)
                out += [(a.vec_id, int(i), int(s)) for i, s in zip(got, scores)]
        yield pd.DataFrame(out, columns=["anchor_id", "other_id", "score"])

    found = "anchor_id long, other_id long, score long"
    first = stored(_searched(rows.where(F.col("bucket") == n_buckets - 1), sent(
        anchors.withColumn("wanted", F.lit(None).cast("array<long>")), F.array(F.lit(n_buckets - 1))), 1, dim, find_positives, found), "longest")
    fifth = first.groupBy("anchor_id").agg(F.when(F.count("*") >= positives, F.min("score")).alias("fifth"))
    asking = stored(anchors.join(fifth.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left").withColumn(
        "wanted", F.when(F.col("fifth").isNotNull(), F.array("fifth"))), "asking")
    others = _searched(rows.where(F.col("bucket") < n_buckets - 1), sent(asking, needed(F.col("fifth"), n_buckets - 2)),
                       max(n_buckets - 1, 1), dim, find_positives, found)
    best_rows = _first(["anchor_id"], positives, first.unionByName(others))
    # a positive below 0 allows nothing: 80 p <= 100 n <= 100 p has no n
    pairs = stored(best_rows.where("score >= 0").select("anchor_id", F.col("other_id").alias("positive_id"), "score"), "positives")

    scores = pairs.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("score")).alias("wanted"))  # ``positives`` at most
    allowed = F.ceil(F.get("wanted", F.lit(0)).cast("double") * (LEAST_PERCENT / 100) * (1 - 1e-9))
    asking = anchors.join(scores, "vec_id")

    def find_negatives(held, index, asks):
        if "all" not in index:
            index["all"] = Bucket(*_joined(held))
        out = []
        for a in asks.itertuples(index=False):
            q, wanted = _unpack(pd.Series([a.packed]), dim)[0], [int(p) for p in a.wanted]
            for p, (got, s) in zip(wanted, negatives_in(index["all"], a.label, q, wanted, negatives)):
                out += [(a.vec_id, p, int(i), int(n)) for i, n in zip(got, s)]
        yield pd.DataFrame(out, columns=["anchor_id", "positive_score", "other_id", "score"])

    near = _searched(rows, sent(asking, needed(allowed, n_buckets - 1)), n_buckets, dim, find_negatives,
                     "anchor_id long, positive_score long, other_id long, score long")
    near = _first(["anchor_id", "positive_score"], negatives, near)
    # positives of one score share their negatives
    return (pairs.withColumnRenamed("score", "positive_score").join(near, ["anchor_id", "positive_score"])
            .select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
