"""Packing: minimum bin slack over the multiset of lengths.

Every document becomes its token ids and a closing id, is cut into full windows, and leaves one tail. How
tails are combined depends only on how many tails have each length, at most ``window`` counts. The plan
takes the longest tail left and fills the window by subset-sum dynamic programming over bitsets of the
remaining multiset, closest to capacity, with the counts traced back; the same window is repeated as often as the
counts allow. A few thousand window patterns at most describe any corpus.

Documents then find their place without being gathered: each task numbers its own tails of every length
while it writes token counts; counts of (task, length) give each task's first number; a number and the
plan give window and offset. The tokenised table is written once, so numbers hold when tasks are re-run.

Defined cases: a null text counts as empty; an empty text is the closing id alone; repeated rows are packed
each; an empty table gives no rows; a null doc_id is carried through; a very long text is encoded whole and fills windows of
its own; added tokens written in a text give their own ids, or with ``plain_added`` those of their characters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edustar.llm.store import stored
from edustar.llm.word_bpe import WordBpe

WINDOW = 4096
CLOSING_ID = 2


# -- the plan -----------------------------------------------------------------------------------------

def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The sub-multiset of counts (length -> how many) whose sum is the largest one up to room."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> room:
            break
    total, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:  # not reachable without this step
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def minimum_bin_slack(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """[(multiset of a window, how many such windows)] that use every length exactly as often as counted."""
    left = {x: n for x, n in counts.items() if n}
    plan = []
    while left:
        anchor = max(left)
        rest = dict(left)
        rest[anchor] -= 1
        used = best_fill(rest, window - anchor)
        used[anchor] = used.get(anchor, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        plan.append((used, times))
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return plan


def lookup(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan by length: for numbers from ``low`` on, a window holds ``count`` tails of this length from
    ``offset`` on, and windows are numbered from ``base``. Sorted by (length, low)."""
    rows, base, seen = [], 0, {}
    for used, times in plan:
        offset = 0
        for x in sorted(used, reverse=True):
            low = seen.get(x, 0)
            rows.append((x, low, used[x], offset, base))
            seen[x] = low + used[x] * times
            offset += x * used[x]
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "low", "count", "offset", "base"), table.T))


def place(table: dict[str, np.ndarray], length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of the number-th tail of a length."""
    window, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    starts = np.searchsorted(table["length"], length, side="left")
    ends = np.searchsorted(table["length"], length, side="right")
    for x in np.unique(length):
        at = np.flatnonzero(length == x)
        a, b = starts[at[0]], ends[at[0]]
        i = a + np.searchsorted(table["low"][a:b], number[at], side="right") - 1
        turn = number[at] - table["low"][i]
        window[at] = table["base"][i] + turn // table["count"][i]
        offset[at] = table["offset"][i] + turn % table["count"][i] * x
    return window, offset


# -- the job ------------------------------------------------------------------------------------------

COUNTED = ("part int, doc_id long, doc_tokens long, crcs array<long>, tail int, tail_number long, full long, full_number long")


def count_tokens(docs: DataFrame, tokenizer: str, window: int = WINDOW, plain_added: bool = False) -> DataFrame:
    """One row a document: its tokens, the crc32 of each piece's ids, and its numbers within its task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, part = WordBpe.load(tokenizer, plain_added), TaskContext.get().partitionId()
        tails, fulls = np.zeros(window + 1, np.int64), 0
        closing, step = CLOSING_ID.to_bytes(4, "little"), 4 * window
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].astype("Int64"), b["text"]):
                ids = bpe.encode_bytes(text or "") + closing
                n = len(ids) // 4
                tail, full = n % window, n // window
                rows.append((part, doc_id, n, [zlib.crc32(ids[i:i + step]) for i in range(0, len(ids), step)],
                             tail, tails[tail], full, fulls))
                tails[tail] += 1
                fulls += full
            yield pd.DataFrame(rows, columns=["part", "doc_id", "doc_tokens", "crcs", "tail", "tail_number", "full", "full_number"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, COUNTED)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, plain_added: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    rows = stored(count_tokens(docs, tokenizer, window, plain_added), "token_counts")
    per_part = stored(rows.groupBy("part", "tail").agg(F.count("*").alias("n"), F.sum("full").alias("full")), "part_counts")

    # the multiset of lengths: at most ``window`` rows
    counts = {r["tail"]: r["n"] for r in per_part.where("tail > 0").groupBy("tail").agg(F.sum("n").alias("n")).collect()}
    fulls = per_part.agg(F.coalesce(F.sum("full"), F.lit(0)).cast("long")).first()[0]
    table = spark.sparkContext.broadcast(lookup(minimum_bin_slack(counts, window)))

    before = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tails = per_part.where("tail > 0").select("part", "tail", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("tail_first"))
    full_parts = _running(per_part.groupBy("part").agg(F.sum("full").alias("full")))
    tail_rows = rows.where("tail > 0").select("part", "doc_id", "doc_tokens", F.element_at("crcs", -1).alias("ids_crc32"), "tail", "tail_number")
    tail_rows = tail_rows.join(tails, ["part", "tail"])

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            length = b["tail"].to_numpy(np.int64)
            at, offset = place(table.value, length, (b["tail_first"] + b["tail_number"]).to_numpy(np.int64))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "start": b["doc_tokens"] - length, "length": length, "ids_crc32": b["ids_crc32"],
                                "doc_tokens": b["doc_tokens"], "sequence_id": at + fulls, "offset": offset})
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    tail_pieces = tail_rows.mapInPandas(placed, schema)

    full_rows = rows.where("full > 0").join(full_parts, "part")
    full_pieces = full_rows.select("doc_id", "doc_tokens", (F.col("first") + F.col("full_number")).alias("first"),
                                   F.posexplode(F.slice("crcs", 1, F.col("full").cast("int"))).alias("i", "ids_crc32")).select(
        "doc_id", (F.col("i") * F.lit(window)).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32",
        "doc_tokens", (F.col("first") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full_pieces.unionByName(tail_pieces)


def _running(parts: DataFrame, width: int = 1024) -> DataFrame:
    """(part, full) -> (part, first): the sum of full over smaller parts, in two levels so that no window
    holds more than ``width`` rows or one row for each ``width`` parts."""
    parts = parts.withColumn("block", F.floor(F.col("part") / width))
    blocks = parts.groupBy("block").agg(F.sum("full").alias("sum"))
    w = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("sum").over(w), F.lit(0)).alias("base"))
    w = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("inside", F.coalesce(F.sum("full").over(w), F.lit(0))).join(blocks, "block").select(
        "part", (F.col("base") + F.col("inside")).alias("first"))
