"""Quality classifier: a weak-label model over heuristic labellers, then a hashed linear scorer.

1. Heuristic labellers each vote good, bad or nothing on every whole text. Their votes overlap and err.
2. The votes of all documents are counted by vote pattern (at most 3**labellers rows). Expectation-
   maximisation on those counts estimates each labeller's accuracy in either class, the share of bad
   documents, and every pattern's posterior. No human label is read.
3. The posteriors label a bounded sample of documents, on which a logistic scorer over hashed features
   (words, word shapes, binned counts) is trained. The scorer decides.

Defined cases: a null text counts as empty; labellers of shares abstain on texts of under MIN_WORDS words;
an empty table gives an empty result; ties at the threshold are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edustar.llm import words
from edustar.llm.store import stored
from edustar.llm.text_stats import text_stats

BITS = 18
#: Documented bound: documents that the scorer is fitted on.
SAMPLE = 8_192
EPOCHS, RATE, L2 = 5, 0.5, 1e-6
KEEP_AT = 0.5
MIN_WORDS = 12

ABSTAIN, GOOD, BAD = 0, 1, 2

#: Symptoms, name -> (statistic, bad at or above, words needed). They never vote good: the lack of one
#: fault says little about the others.
SYMPTOMS = {
    "repeated_words": ("repeated", 0.20, MIN_WORDS),
    "upper_case": ("upper", 0.30, MIN_WORDS),
    "signs": ("signs", 0.12, MIN_WORDS),
    "table_bars": ("bars", 0.20, MIN_WORDS),
    "same_lines": ("same_lines", 0.30, MIN_WORDS),
    "digits": ("digits", 0.30, 20),
    "long_words": ("word_length", 14.0, MIN_WORDS),
    "few_distinct": ("alike", 0.65, 60),
}
#: Signs of prose, name -> (statistic, bad at or below, good at or above, words needed).
PROSE = {
    "plain_words": ("plain", 0.60, 0.85, MIN_WORDS),
    "function_words": ("function", 0.01, 0.10, 40),
}
LABELLERS = (*SYMPTOMS, *PROSE)


def votes(stats: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, labellers) of ABSTAIN, GOOD, BAD."""
    n = stats["n_words"]
    out = np.zeros((len(n), len(LABELLERS)), np.int8)
    for j, (stat, bad, least) in enumerate(SYMPTOMS.values()):
        out[:, j] = np.where((n >= least) & (stats[stat] >= bad), BAD, ABSTAIN)
    for j, (stat, bad, good, least) in enumerate(PROSE.values(), len(SYMPTOMS)):
        x = stats[stat]
        out[:, j] = np.where(n < least, ABSTAIN, np.where(x <= bad, BAD, np.where(x >= good, GOOD, ABSTAIN)))
    return out


def pattern(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ (3 ** np.arange(v.shape[1], dtype=np.int64))


def unpack(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] // 3 ** np.arange(len(LABELLERS), dtype=np.int64)) % 3


#: Starting vote probabilities (abstain, good, bad) in a good and a bad document, and their weight as
#: earlier observations, which keeps "bad" meaning bad when the corpus has little or none of it.
START = np.array([[0.36, 0.62, 0.02], [0.45, 0.25, 0.30]])
START_WEIGHT, START_BAD = 20.0, 0.1


def expectation_maximisation(v: np.ndarray, count: np.ndarray, rounds: int = 200) -> dict:
    """Votes (patterns, labellers) and their counts -> {"theta": (labellers, class, vote), "bad": share,
    "posterior": P(bad) of each pattern}."""
    m = v.shape[1]
    theta = np.broadcast_to(START, (m, 2, 3)).copy()
    prior, posterior = START_BAD, np.zeros(len(v))
    one_hot = np.stack([(v == k).astype(float) for k in range(3)], axis=2)
    for _ in range(rounds):
        like = np.einsum("pmk,mck->pc", one_hot, np.log(theta)) + np.log([1 - prior, prior])
        now = 1.0 / (1.0 + np.exp(np.clip(like[:, 0] - like[:, 1], -700, 700)))
        weight = np.stack([(1 - now) * count, now * count])
        theta = np.einsum("cp,pmk->mck", weight, one_hot) + START_WEIGHT * START
        theta /= theta.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + START_WEIGHT * START_BAD) / (count.sum() + START_WEIGHT)
        done = np.max(np.abs(now - posterior), initial=0.0) < 1e-9
        posterior = now
        if done:
            break
    return {"theta": theta, "bad": float(prior), "posterior": posterior}


def label_model(docs: DataFrame) -> dict:
    """EM over the vote patterns of all documents; the driver receives one count for each pattern."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            texts = s.tolist()
            yield pd.Series(np.concatenate([np.zeros(0, np.int64), *[
                pattern(votes(text_stats(texts[p])[0])) for p in words.slices(texts)]]))
    rows = docs.select(F.pandas_udf(run, "long")("text").alias("pattern")).groupBy("pattern").count().collect()
    codes = np.array(sorted((r["pattern"], r["count"]) for r in rows), np.int64).reshape(-1, 2)
    v = unpack(codes[:, 0])
    model = expectation_maximisation(v, codes[:, 1].astype(float)) if len(codes) else {"theta": None, "bad": START_BAD, "posterior": np.zeros(0)}
    return model | {"patterns": codes[:, 0]}


# -- the scorer ---------------------------------------------------------------------------------------

_BINS = {"repeated": 20, "upper": 20, "signs": 40, "alike": 10, "bars": 20, "same_lines": 10, "word_length": 1, "digits": 20, "plain": 20, "function": 40}


def scorer_features(texts, bits: int = BITS):
    """Sparse rows (text, feature, value) of hashed words, word shapes and binned counts, and the statistics.
    Words and shapes count by their share, each kind scaled to length 1."""
    stats, (hashes, first), shapes = text_stats(texts)
    doc, ids, values = [], [], []
    for salt, (h, f) in enumerate(((hashes, first), shapes)):
        d = np.repeat(np.arange(len(f) - 1), np.diff(f))
        x = words.mix(h + np.uint64(salt)) >> np.uint64(64 - bits)
        both, n = np.unique((d << bits) | x.astype(np.int64), return_counts=True)
        d, n = both >> bits, n.astype(float)
        size = np.sqrt(np.bincount(d, n * n, minlength=len(texts)))
        doc.append(d)
        ids.append(both & ((1 << bits) - 1))
        values.append(n / size[d])
    for i, (name, scale) in enumerate(_BINS.items()):
        level = np.minimum((stats[name] * scale).astype(np.int64), 63)
        key = words.mix(np.uint64(1_000 * (i + 1)) + level.astype(np.uint64)) >> np.uint64(64 - bits)
        doc.append(np.arange(len(texts)))
        ids.append(key.astype(np.int64))
        values.append(np.where(stats["n_words"] >= MIN_WORDS, 0.5, 0.0))
    doc, ids, values = np.concatenate(doc), np.concatenate(ids), np.concatenate(values)
    order = np.argsort(doc, kind="stable")
    return doc[order], ids[order], values[order], stats


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: list[float], bits: int = BITS) -> np.ndarray:
    """Logistic weights (the last is the intercept) by AdaGrad on soft targets P(good)."""
    w, square = np.zeros((1 << bits) + 1), np.full((1 << bits) + 1, 1e-2)
    for _ in range(EPOCHS):
        for (i, x), y in zip(rows, target):
            i, x = np.append(i, 1 << bits), np.append(x, 1.0)
            g = (1.0 / (1.0 + np.exp(-np.clip(w[i] @ x, -35, 35))) - y) * x + L2 * w[i]
            square[i] += g * g
            w[i] -= RATE * g / np.sqrt(square[i])
    return w


def fit(docs: DataFrame, bits: int = BITS, sample: int = SAMPLE) -> dict:
    """The label model over all documents and the scorer over about ``sample`` of them, chosen by a hash of
    the text. The driver receives the non-zero weights, 2**bits at most."""
    model = label_model(docs)
    posterior = dict(zip(model["patterns"].tolist(), model["posterior"].tolist()))
    total = docs.select("text").count()
    every = max(1, -(-total // sample))
    chosen = docs.select("text").where(F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(every)) == 0)
    # copies of one text all share its hash: each text once keeps the sample's bound whatever the copies
    chosen = chosen.distinct()

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for part in words.slices(texts):
                doc, ids, values, stats = scorer_features(texts[part], bits)
                cut = np.searchsorted(doc, np.arange(len(texts[part]) + 1))
                bad = [posterior.get(p, model["bad"]) for p in pattern(votes(stats)).tolist()]
                yield pd.DataFrame({"target": 1.0 - np.array(bad), "ids": [ids[x:y].astype("<i4").tobytes() for x, y in zip(cut[:-1], cut[1:])],
                                    "vals": [values[x:y].astype("<f4").tobytes() for x, y in zip(cut[:-1], cut[1:])]})
    rows = stored(chosen.mapInPandas(features, "target double, ids binary, vals binary"), "quality_features")

    def train(b: pd.DataFrame) -> pd.DataFrame:
        b = b.assign(order=[zlib.crc32(x) for x in b["ids"]]).sort_values(["order", "ids"])
        w = fit_scorer([(np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4")) for i, v in zip(b["ids"], b["vals"])], b["target"].tolist(), bits)
        at = np.flatnonzero(w)
        return pd.DataFrame({"index": [at.astype("<i4").tobytes()], "weight": [w[at].astype("<f8").tobytes()]})
    found = rows.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(train, "index binary, weight binary").collect()
    weights = np.zeros((1 << bits) + 1)
    for r in found:
        weights[np.frombuffer(r["index"], "<i4")] = np.frombuffer(r["weight"], "<f8")
    return model | {"weights": weights.astype(np.float32), "posteriors": posterior}


def score_texts(texts, model: dict, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """P(good) by the scorer and P(bad) by the label model."""
    score, bad = np.zeros(len(texts)), np.zeros(len(texts))
    w = model["weights"]
    for part in words.slices(texts):
        doc, ids, values, stats = scorer_features(texts[part], bits)
        z = np.bincount(doc, w[ids] * values, minlength=part.stop - part.start) + w[-1]
        score[part] = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
        bad[part] = [model["posteriors"].get(p, model["bad"]) for p in pattern(votes(stats)).tolist()]
    return score, bad


def classify(docs: DataFrame, keep_at: float = KEEP_AT, bits: int = BITS) -> DataFrame:
    """doc_id, score P(good), posterior_bad by the labellers alone, kept."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, bits))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            score, bad = score_texts(b["text"].tolist(), sent.value, bits)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": score, "posterior_bad": bad, "kept": score >= keep_at})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, score double, posterior_bad double, kept boolean")


def drop_low_quality(docs: DataFrame, keep_at: float = KEEP_AT, bits: int = BITS) -> DataFrame:
    """The rows, all columns kept, that the scorer accepts."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, bits))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(score_texts(s.tolist(), sent.value, bits)[0])
    return docs.where(F.pandas_udf(run, "double")("text") >= keep_at)
