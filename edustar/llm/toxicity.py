"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct hashes of its words, word pairs and pairs that skip one word, each
present or absent (so one insult counts the same in a short and in a very long text). Per-coordinate
learning rates and L1 leave few weights above zero; only those travel to the tasks that score.

Fitting: at most about ``SAMPLE`` labelled rows, chosen by a hash of doc_id, are turned into features in
parallel and dealt to shards; each shard runs FTRL over its rows and the shards' weights are averaged.
Scoring: one pass over all whole texts.

Defined cases: a null text counts as empty; an empty text scores by the intercept alone; a doc_id with
several labels is toxic if any of them is; with no usable label every text scores 0; rows with a null
doc_id are scored and not fitted on (their crc is that of the empty string).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edustar.llm import words
from edustar.llm.store import stored

BITS = 22
ALPHA, BETA, L1, L2 = 4.0, 1.0, 4.0, 0.0
EPOCHS = 4
#: Documented bounds of the fit: labelled rows, and rows in a shard.
SAMPLE, SHARD_ROWS, MAX_SHARDS = 16_384, 16_384, 4
THRESHOLD = 0.7

_WIDE_SIGNS = re.compile("[  -⁯　-〿]")
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_ids(texts, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature number) of every word, pair and skip-pair, with repeats."""
    texts = [t if not t or t.isascii() else _WIDE_SIGNS.sub(" ", t) for t in texts]
    h, first = words.word_hashes(texts, words.NOT_ALNUM)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out, docs = [h], [doc]
    for gap in (1, 2):
        if len(h) > gap:
            inside = doc[gap:] == doc[:-gap]
            out.append(words.mix(h[:-gap] * _A + h[gap:] * _B + np.uint64(gap))[inside])
            docs.append(doc[:-gap][inside])
    return np.concatenate(docs), (np.concatenate(out) >> np.uint64(64 - bits)).astype(np.int64)


def distinct(doc: np.ndarray, ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((doc << bits) | ids)
    return both >> bits, both & ((1 << bits) - 1)


class Ftrl:
    """FTRL-proximal state: one (z, n) pair a coordinate; the last coordinate is the intercept."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.size, self.alpha, self.beta, self.l1, self.l2 = size, alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        shrunk = np.where(i == self.size, z, np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0))
        return -shrunk / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)

    def learn(self, i: np.ndarray, label: float) -> None:
        w = self.weights(i)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g


def fit_rows(features: list[np.ndarray], labels: list[float], bits: int = BITS, epochs: int = EPOCHS) -> Ftrl:
    model = Ftrl(1 << bits)
    for _ in range(epochs):
        for f, y in zip(features, labels):
            model.learn(np.append(f, np.int32(1 << bits)), y)
    return model


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, sample: int = SAMPLE) -> dict:
    """docs (doc_id, text) and labels (doc_id, label 0/1) -> {"index", "weight", "bias"}, non-zero weights only.
    The driver receives at most MAX_SHARDS sparse weight lists over 2**bits coordinates."""
    marked = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    n = marked.count()
    every = max(1, -(-n // sample))
    shards = max(1, min(MAX_SHARDS, n // every // SHARD_ROWS))
    marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in words.slices(b["text"].tolist()):
                rows = b.iloc[part]
                doc, ids = distinct(*gram_ids(rows["text"].tolist(), bits), bits)
                cut = np.searchsorted(doc, np.arange(len(rows) + 1))
                yield pd.DataFrame({"shard": rows["shard"].values, "doc_id": rows["doc_id"].values, "label": rows["label"].values,
                                    "ids": [ids[x:y].astype("<i4").tobytes() for x, y in zip(cut[:-1], cut[1:])]})

    rows = docs.select("doc_id", "text").join(marked, "doc_id").withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int"))
    rows = stored(rows.mapInPandas(features, "shard int, doc_id long, label int, ids binary"), "toxic_features")

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(order=words.mix(rows["doc_id"].to_numpy().astype(np.uint64))).sort_values(["order", "ids"])
        model = fit_rows([np.frombuffer(x, "<i4") for x in rows["ids"]], rows["label"].tolist(), bits)
        w = model.weights(np.arange((1 << bits) + 1))
        at = np.flatnonzero(w)
        return pd.DataFrame({"index": [at.astype("<i4").tobytes()], "weight": [w[at].astype("<f8").tobytes()], "bias": [float(w[-1])]})

    found = rows.groupBy("shard").applyInPandas(train, "index binary, weight binary, bias double").collect()
    mean = np.zeros((1 << bits) + 1)
    for r in found:
        mean[np.frombuffer(r["index"], "<i4")] += np.frombuffer(r["weight"], "<f8") / len(found)
    at = np.flatnonzero(mean[:-1])
    return {"index": at.astype(np.int32), "weight": mean[at], "bias": float(mean[-1]) if found else None}


def score_texts(texts, model: dict, bits: int = BITS) -> np.ndarray:
    """Probability of label 1 for each text."""
    out = np.full(len(texts), 0.0 if model["bias"] is None else model["bias"])
    if model["bias"] is None:
        return out
    dense, some = _dense(model, bits)
    for part in words.slices(texts):
        doc, ids = gram_ids(texts[part], bits)
        has = some[ids]
        doc, ids = distinct(doc[has], ids[has], bits)
        np.add.at(out, doc + part.start, dense[ids])
    return 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))


def _dense(model: dict, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights by feature and which are not zero; kept with the (broadcast) model, once a worker."""
    if "dense" not in model:
        dense = np.zeros(1 << bits, np.float32)
        dense[model["index"]] = model["weight"]
        model["dense"] = dense, dense != 0
    return model["dense"]


def held_out_flag(doc_id=None):
    """crc32(doc_id as text) mod 3 = 1; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id or "doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def score_documents(docs: DataFrame, model: dict, bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(score_texts(s.tolist(), sent.value, bits))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out_flag().alias("held_out"),
                       F.pandas_udf(run, "double")("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> dict:
    """The fit that leaves the held-out third of the labels alone."""
    return fit(docs, labels.where(~held_out_flag()).select("doc_id", F.col("toxic").cast("int").alias("label")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, fit_on_labels(docs, labels))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BITS) -> DataFrame:
    """The rows, all columns kept, whose score is under the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(fit_on_labels(docs, labels))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(score_texts(s.tolist(), sent.value, bits))
    return docs.where(F.pandas_udf(run, "double")("text") < threshold)
