"""Embedding near-duplicates: product quantisation over coarse inverted lists.

1. Usable vectors are scaled to length 1 in double precision and written once with a row number.
2. On a bounded sample, coarse centroids (spherical k-means) and one codebook for each sub-space of the
   residuals are fitted.
3. Every vector goes to its nearest list with the residual's codes and the length of what the codes miss.
4. Every vector asks its ``PROBES`` nearest lists. Lists and askers are cut into blocks by a hash, so a list
   that holds a third of all rows is many tasks. Inside a block, asymmetric table look-ups give q·x'; since
   |q·x - q·x'| is at most the missed length, candidates are exactly those that could reach the threshold.
5. Candidates are reranked by the exact cosine. A block returns, for each vector, how many links it found
   and the smallest row it reaches there: never pairs.
6. Links within blocks join up by connected components.

A pair is found if either vector's probes include the other's list; recall against brute force is tested.

Defined cases: null, empty or zero vectors and those with null or non-finite components link with nothing;
vectors of unlike length are compared as if the shorter one had zeros behind it; repeated rows are vectors of their own
(rows of one vec_id share its component's smallest id); a null vec_id is never a component's id unless
alone; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edustar.llm.components import components
from edustar.llm.store import stored

THRESHOLD = 0.9
PROBES = 8
LIST_ROWS, MAX_LISTS = 512, 4096
SUBSPACES, CODES = 8, 256
#: Documented bound of the fit.
SAMPLE = 16_384
MEMBER_BLOCK, ASKER_BLOCK = 1024, 4096


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int, unit: bool) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), size=min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        near = _nearest(x, c, 1)[:, 0]
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        if unit:
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _nearest(x: np.ndarray, c: np.ndarray, p: int) -> np.ndarray:
    """The p nearest centroids of each row, nearest first."""
    out = np.empty((len(x), p), np.int32)
    half = 0.5 * (c * c).sum(axis=1)
    for a in range(0, len(x), 2048):
        s = half - x[a:a + 2048] @ c.T
        if p == 1:
            out[a:a + 2048, 0] = s.argmin(axis=1)
        else:
            some = np.argpartition(s, p - 1, axis=1)[:, :p]
            out[a:a + 2048] = np.take_along_axis(some, np.take_along_axis(s, some, 1).argsort(axis=1, kind="stable"), 1)
    return out


class Quantiser:
    """Coarse centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES):
        self.centroids = _kmeans(sample, lists, 12, 1, unit=True)
        residual = sample - self.centroids[_nearest(sample, self.centroids, 1)[:, 0]]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        self.books = [_kmeans(residual[:, d], codes, 8, 2 + i, unit=False) for i, d in enumerate(self.cuts)]

    def encode(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of what they miss) of rows in their home lists."""
        residual = x - self.centroids[home]
        codes, missed = np.empty((len(x), len(self.cuts)), np.uint8), np.zeros(len(x))
        for i, (d, book) in enumerate(zip(self.cuts, self.books)):
            near = _nearest(residual[:, d], book, 1)[:, 0]
            codes[:, i] = near
            missed += ((residual[:, d] - book[near]) ** 2).sum(axis=1)
        return codes, np.sqrt(missed)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(subspace, query, code): the part of q·x' that each code gives."""
        return np.stack([np.pad(q[:, d] @ book.T, ((0, 0), (0, CODES - len(book)))) for d, book in zip(self.cuts, self.books)])


def _vectors(column: pd.Series, dim: int) -> np.ndarray:
    """Unit rows in double precision; all-zero rows for vectors that link with nothing."""
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        if v is not None and len(v):
            x = np.array([np.nan if c is None else c for c in v], np.float64) if v.dtype == object else v.astype(np.float64)
            size = np.abs(x).max()
            if np.isfinite(size) and size > 0:
                x = x / size  # keeps squares in range
                out[i, :len(x)] = x / np.linalg.norm(x)
    return out


def _block_links(q: np.ndarray, x: np.ndarray, missed: np.ndarray, codes: np.ndarray, centroid: np.ndarray,
                 quantiser: Quantiser, q_row: np.ndarray, x_row: np.ndarray, threshold: float) -> np.ndarray:
    """(askers, members) of exact links, found through the look-up tables."""
    out = np.zeros((len(q), len(x)), bool)
    for a in range(0, len(q), 128):
        part = q[a:a + 128]
        near = np.repeat((part @ centroid)[:, None], len(x), axis=1)
        for table, code in zip(quantiser.tables(part), codes.T):
            near += table[:, code]
        i, j = np.nonzero((near >= threshold - missed - 1e-9) & (q_row[a:a + 128, None] != x_row))
        for b in range(0, len(i), 65_536):
            ii, jj = i[b:b + 65_536], j[b:b + 65_536]
            good = np.einsum("ij,ij->i", part[ii], x[jj]) >= threshold
            out[a + ii[good], jj[good]] = True
    return out


def _reach(links: np.ndarray, q_row: np.ndarray, x_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest row that each asker and each member reaches through this block's links."""
    left, right = q_row.copy(), x_row.copy()
    big = np.iinfo(np.int64).max
    while True:
        lo = np.minimum(left, np.where(links, right, big).min(axis=1, initial=big))
        ro = np.minimum(right, np.where(links, lo[:, None], big).min(axis=0, initial=big))
        if (lo == left).all() and (ro == right).all():
            return left, right
        left, right = lo, ro


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, probes: int = PROBES) -> DataFrame:
    """vectors (vec_id, embedding, ...) -> vec_id, n_links, component_id, kept for every row."""
    spark = vectors.sparkSession
    size = vectors.agg(F.max(F.size("embedding"))).first()[0]
    dim = max(int(size or 0), 1)

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _vectors(b["embedding"], dim)
            yield pd.DataFrame({"row": b["row"], "vec_id": b["vec_id"].astype("Int64"), "usable": x.any(axis=1), "unit": [v.tobytes() for v in x]})
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInPandas(
        prepare, "row long, vec_id long, usable boolean, unit binary")
    rows = stored(rows, "unit_vectors")
    usable = rows.where("usable").select("row", "unit")
    n = usable.count()
    if n < 2:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))

    every = -(-n // SAMPLE)
    sample = usable.where(F.pmod(F.xxhash64("row"), F.lit(every)) == 0)
    sample = np.stack([np.frombuffer(r["unit"]) for r in sample.orderBy("row").select("unit").collect()] or [np.ones(dim)])  # SAMPLE rows or so
    lists = max(1, min(MAX_LISTS, -(-n // LIST_ROWS), len(sample)))
    model = spark.sparkContext.broadcast(Quantiser(sample, lists))
    p = min(probes, lists)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            x = np.stack([np.frombuffer(v) for v in b["unit"]]) if len(b) else np.zeros((0, dim))
            near = _nearest(x, m.centroids, min(p, len(m.centroids)))
            codes, missed = m.encode(x, near[:, 0])
            yield pd.DataFrame({"row": b["row"], "unit": b["unit"], "home": near[:, 0], "probes": list(near), "codes": [c.tobytes() for c in codes], "missed": missed})
    homes = stored(usable.mapInPandas(assign, "row long, unit binary, home int, probes array<int>, codes binary, missed double"), "lists")

    # one row a list: MAX_LISTS at most
    members = homes.groupBy("home").agg(F.count("*").alias("n_members")).withColumnRenamed("home", "list")
    askers = homes.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count("*").alias("n_askers"))
    cuts = F.broadcast(members.join(askers, "list").select(
        "list", F.ceil(F.col("n_members") / MEMBER_BLOCK).cast("int").alias("mb"), F.ceil(F.col("n_askers") / ASKER_BLOCK).cast("int").alias("ab")))
    block = lambda salt, n: F.pmod(F.xxhash64("row", F.lit(salt)), F.col(n)).cast("int")
    member_rows = homes.withColumn("list", F.col("home")).join(cuts, "list").select(
        "list", block(1, "mb").alias("m"), F.explode(F.sequence(F.lit(0), F.col("ab") - 1)).alias("a"), F.lit(True).alias("member"),
        "row", "unit", "home", "probes", "codes", "missed")
    asker_rows = homes.withColumn("list", F.explode("probes")).join(cuts, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("m"), block(2, "ab").alias("a"), F.lit(False).alias("member"),
        "row", "unit", "home", "probes", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("missed"))

    def link(b: pd.DataFrame) -> pd.DataFrame:
        m = model.value
        ask, own = b[~b["member"]].sort_values("row"), b[b["member"]].sort_values("row")
        if not len(ask) or not len(own):
            return pd.DataFrame({"row": [], "links": [], "reach": []})
        here = int(b["list"].iloc[0])
        q, x = (np.stack([np.frombuffer(v) for v in d["unit"]]) for d in (ask, own))
        codes = np.stack([np.frombuffer(c, np.uint8) for c in own["codes"]])
        q_row, x_row = ask["row"].to_numpy(), own["row"].to_numpy()
        links = _block_links(q, x, own["missed"].to_numpy(), codes, m.centroids[here], m, q_row, x_row, threshold)
        # a member counts a link itself unless it asks the asker's list and so finds the link there
        asked = (np.stack(list(own["probes"]))[:, None, :] == ask["home"].to_numpy()[None, :, None]).any(axis=2).T
        left, right = _reach(links, q_row, x_row)
        some_q, some_x = links.any(axis=1), links.any(axis=0)
        return pd.DataFrame({
            "row": np.concatenate((q_row[some_q], x_row[some_x])),
            "links": np.concatenate((links.sum(axis=1)[some_q], (links & ~asked).sum(axis=0)[some_x])),
            "reach": np.concatenate((left[some_q], right[some_x]))})
    found = stored(member_rows.unionByName(asker_rows).groupBy("list", "m", "a").applyInPandas(link, "row long, links long, reach long"), "links_found")

    n_links = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    joined = components(found.select(F.col("row").alias("a"), F.col("reach").alias("b")))
    linked = stored(joined.join(rows.select(F.col("row").alias("node"), "vec_id"), "node"), "components")
    smallest = linked.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    of_row = linked.join(smallest, "component").select(F.col("node").alias("row"), "component_id")
    return (rows.select("row", "vec_id").join(n_links, "row", "left").join(of_row, "row", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
