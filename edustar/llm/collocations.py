"""Phrase collocation mining by dynamic itemset counting.

The texts are normalised once (A-Z in lower case, words with one blank between, pieces on lines of their own) and
written as ``SHARDS`` shards. Then the shards are scanned in a cycle, one a step, for phrases of all lengths at once:

* Words count from the first step on. A longer phrase becomes active at the end of the step in which the later one of
  its two subphrases (all but its last word, all but its first) reaches the threshold; from the next step on it is
  counted beside the shorter ones, whatever shard the cycle has come to.
* A phrase is done when the cycle has passed all shards since it became active. When no phrase can be active any
  more, the scan stops, after three cycles at most (one for each length).

A step writes the hashes of the active phrases of each block of text with their counts (capped at the threshold), packed
by ranges of the hash; after a step, one task for each range adds up what the open phrases have so far. Hashes that
reach the threshold enter a table of ``SLOTS`` bytes: the top bits of the hash lead to the step of the first entry. It
is all that the tasks of the next step need to tell which phrases are active. Hashes that collide can only make a
phrase active early or needlessly, and each phrase has one step at which it becomes active, so it is counted in every
shard once. A last scan names the phrases that reached the threshold by tables of bits, FINE_BITS more of the hash to a
place (so few others pass), and adds them up by the phrase itself, so counts are exact and no hash decides one (within a
block of text phrases are told apart by 64 bits). The tables do not grow with the input, only their use as filters
falls; ranges grow with the input. A step's shuffle files go when its sums are known.

Defined cases: a null text counts as empty; a text without words changes nothing; a null lang is the lang "und"; very
long texts are counted whole (in blocks that end where a piece does); repeated rows count as often as they occur; ties
in score are settled by count, then by phrase; an empty table gives an empty result; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from edustar.llm import words as W
from edustar.llm.store import shuffle_partitions, stored

THRESHOLD, LENGTHS = 10, 3
SHARDS = 3
#: The table of phrases that reached the threshold has 2^SLOT_BITS bytes.
SLOT_BITS = 22
#: The last scan's tables have a bit for each slot of this many more bits of the hash: no more bytes than the steps' table.
FINE_BITS = 3
#: Words of the input for each range of hashes, which one task adds up; a hash keeps REST_BITS below its range.
RANGE_WORDS, REST_BITS = 4 << 20, 40
#: Bytes of text that are counted at once in a task.
BLOCK = 4 << 20
#: Words that one task of the last scan names: more words, fewer rows of the same phrase to add up.
TASK_WORDS = 8 << 20
TOP, SALTS = 2000, 16
#: A longer phrase with this share (per cent) of a candidate's count takes its place.
COVERED = 50

# Fixed values of the word rule.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_SEP = _BLANK | _CUT
_LINE = 10


def gather(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs buf[start:start + size] one behind another, and where each begins (one more entry)."""
    at = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return buf[np.arange(at[-1], dtype=np.int64) + np.repeat(starts - at[:-1], sizes)], at


def strings(buf: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(buf.tobytes())).cast(pa.string())


def normalise(raw: bytes) -> bytes:
    """Each word with one sign behind it: a blank if the piece goes on, a line feed if it ends."""
    buf = _LOWER[np.frombuffer(raw, np.uint8)]
    starts, ends = W.runs(buf, _SEP)
    if not len(starts):
        return b""
    cuts = np.concatenate(([0], np.cumsum(_CUT[buf])))
    last = np.concatenate((starts[1:], [len(buf)]))
    goes_on = cuts[ends] == cuts[last]
    goes_on[-1] = False
    padded = np.concatenate((buf, [np.uint8(0)]))
    out, at = gather(padded, starts, ends - starts + 1)
    out[at[1:] - 1] = np.where(goes_on, 0x20, _LINE)
    return out.tobytes()


def shards(docs: DataFrame, n: int) -> DataFrame:
    """docs (text, lang, ...) -> shard, lang, n_words, pieces: the normalised texts with words, written by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in W.slices(b.column(1).to_pylist()):
                texts = [normalise((t or "").encode("utf-8")) for t in b.column(1)[part].to_pylist()]
                count = [t.count(b" ") + t.count(b"\n") for t in texts]
                yield pa.RecordBatch.from_arrays([
                    b.column(2)[part].cast(pa.int32()), b.column(0)[part].cast(pa.string()), pa.array(count, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string())], ["shard", "lang", "n_words", "pieces"])
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("lang", "text"), F.lit(n)).cast("int"))
    return rows.select("lang", "text", "shard").mapInArrow(run, "shard int, lang string, n_words long, pieces string").where("n_words > 0")


def _seed(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode("utf-8") + b"\n", np.uint8)
    return W.hash_runs(raw, np.array([0]), np.array([len(raw)]))[0]


def _blocks(raw: bytes, block: int) -> Iterator[bytes]:
    """``raw`` in blocks of ``block`` bytes or so that end where a piece does (a phrase never crosses pieces)."""
    at = 0
    while at < len(raw):
        end = raw.rfind(b"\n", at, at + block) + 1 or raw.find(b"\n", at + block) + 1 or len(raw)
        yield raw[at:end]
        at = end


def _phrases(lang: str, buf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For 1, 2, ... words: the hash of the phrase that begins at each word, whether it lies in one piece, and where it
    begins and ends."""
    starts, ends = W.runs(buf, _SEP)
    key = words = W.mix(W.hash_runs(buf, starts, ends) + _seed(lang))
    joins = buf[ends] != _LINE  # the piece goes on behind the word
    whole = np.ones(len(words), bool)
    for n in range(1, LENGTHS + 1):
        if n > 1:
            m = max(len(words) - n + 1, 0)
            key = W.mix(key[:m] * np.uint64(0xD1342543DE82EF95) + words[n - 1:])
            whole = whole[:m] & joins[n - 2:n - 2 + m]
        yield key, whole, starts[:len(key)], ends[n - 1:]


def _steps(slots: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The step of each hash's slot (its top bits; the table's length is a power of two)."""
    return slots[(key >> np.uint64(65 - len(slots).bit_length())).astype(np.int64)]


def _mark(table: np.ndarray, places: np.ndarray) -> None:
    """Set the bits of a table of bits."""
    for b in range(8):
        table[places[places & 7 == b] >> 3] |= np.uint8(1 << b)


def _marked(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each hash's bit (its top bits; the table's length is a power of two) is set."""
    place = (key >> np.uint64(62 - len(table).bit_length())).astype(np.int64)
    return table[place >> 3] >> (place & 7).astype(np.uint8) & 1 > 0


def _blocks_of(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[str, np.ndarray]]:
    for b in batches:
        langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        for part in W.slices(texts, block):
            of: dict[str, list[str]] = {}
            for lang, text in zip(langs[part], texts[part]):
                of.setdefault(lang, []).append(text)
            for lang, some in of.items():
                for raw in _blocks("".join(some).encode("utf-8"), block):
                    yield lang, np.frombuffer(raw, np.uint8)


def pack_rest(key: np.ndarray, bits: int) -> np.ndarray:
    """The REST_BITS of each hash below its top ``bits``, in five bytes."""
    rest = (key << np.uint64(bits)) >> np.uint64(64 - REST_BITS)
    return rest.view(np.uint8).reshape(-1, 8)[:, :REST_BITS // 8]


def unpack_rest(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def _step_counts(shard: DataFrame, slots, step: int, cycle: int, bits: int, cap: int, block: int) -> DataFrame:
    """One step: for each block of text, k, since (the step that made the phrases active) and range of hashes, the
    hashes and counts of the active phrases. Words are active in the first cycle."""
    kind = np.min_scalar_type(cap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value if slots is not None else None
        for lang, buf in _blocks_of(batches, block):
            before, out = None, []
            for k, (key, whole, _, _) in enumerate(_phrases(lang, buf), start=1):
                if k == 1:
                    since = np.zeros(len(key), np.uint8)
                    active = np.full(len(key), step <= cycle)
                else:
                    a, b = before[:-1], before[1:]
                    since = np.maximum(a, b)
                    active = whole & (a > 0) & (b > 0) & (since >= max(step - cycle, 1))
                for s in np.unique(since[active]):
                    some, count = np.unique(key[active & (since == s)], return_counts=True)
                    where = (some >> np.uint64(64 - bits)).astype(np.int64)
                    edges = np.concatenate((np.flatnonzero(np.diff(where, prepend=-1)), [len(where)]))
                    rest, capped = pack_rest(some, bits), np.minimum(count, cap).astype(kind)
                    out += [(k, int(s), int(where[i]), rest[i:j].tobytes(), capped[i:j].tobytes()) for i, j in zip(edges, edges[1:])]
                if table is None or k == LENGTHS:
                    break
                before = np.where(whole, _steps(table, key), 0)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int8(), pa.int8(), pa.int32(), pa.binary(), pa.binary()))],
                                                 ["k", "since", "part", "rest", "counts"])
    return shard.select("lang", "pieces").mapInArrow(run, "k byte, since byte, part int, rest binary, counts binary")


def _reached(counts: DataFrame, bits: int, cap: int, slot_bits: int) -> np.ndarray:
    """The slots of hashes whose counts come to the threshold. A range of hashes holds slots of its own, so one packed
    row a range comes to the driver, 2^slot_bits slots of 4 bytes at most in all."""
    kind = np.min_scalar_type(cap)

    def add(rests: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key, place = np.unique(np.concatenate(rests), return_inverse=True)
        return key, np.bincount(place, np.concatenate(counts), len(key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rests, totals = None, [], []

        def slots() -> pa.RecordBatch:
            key, total = add(rests, totals)
            full = key[total >= cap] | np.uint64(part << REST_BITS)
            found = np.unique(full >> np.uint64(bits + REST_BITS - slot_bits))
            return pa.RecordBatch.from_arrays([pa.array([found.astype(np.int32).tobytes()], pa.binary())], ["slots"])
        for b in batches:
            for p, rest, count in zip(*(b.column(i).to_pylist() for i in range(3))):
                if part is not None and p != part:
                    yield slots()
                    rests, totals = [], []
                part = p
                rests.append(unpack_rest(rest))
                totals.append(np.frombuffer(count, kind).astype(np.float64))
                if len(rests) > 64:  # repeated hashes of many blocks become one
                    rests, totals = ([x] for x in add(rests, totals))
        if rests:
            yield slots()
    n = max(1, min(1 << bits, 4 * shuffle_partitions(counts)))
    rows = counts.select("part", "rest", "counts").repartition(n, "part").sortWithinPartitions("part")
    conf, free = counts.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(free)
    conf.set(free, "true")  # nothing reads this shuffle again, and each step has one
    try:
        found = rows.mapInArrow(run, "slots binary").collect()
    finally:
        conf.set(free, before)
    return np.frombuffer(b"".join(bytes(r["slots"]) for r in found), np.int32)


def _named(table: DataFrame, slots, block: int) -> DataFrame:
    """All phrases whose bits are set, with their counts by the phrase itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = slots.value
        for lang, buf in _blocks_of(batches, block):
            before = None
            for k, (key, whole, starts, ends) in enumerate(_phrases(lang, buf), start=1):
                active = whole & _marked(tables[k == LENGTHS], key)
                if before is not None:
                    active &= before[:-1] & before[1:]
                before = active
                at = np.flatnonzero(active)
                if not len(at):
                    break
                _, first, count = np.unique(key[at], return_index=True, return_counts=True)
                begin = at[first]
                text, where = gather(buf, starts[begin], ends[begin] - starts[begin])
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(lang), len(begin)), pa.repeat(pa.scalar(k, pa.int8()), len(begin)), strings(text, where),
                    pa.array(count.astype(np.int64))], ["lang", "k", "phrase", "c"])
    return (table.select("lang", "pieces").mapInArrow(run, "lang string, k byte, phrase string, c long")
            .groupBy("lang", "k", "phrase").agg(F.sum("c").alias("f")))


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD, n_shards: int = SHARDS, slot_bits: int = SLOT_BITS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """docs (text, lang, ...) -> (lang, k, phrase, f) for the phrases of up to LENGTHS words that occur ``threshold`` times or
    more in their language, and (lang, n): all words of each language."""
    if not 1 <= n_shards <= 40 or threshold < 1 or not 1 <= slot_bits <= 30:
        raise ValueError("1 to 40 shards, a threshold of 1 or more, 1 to 30 slot bits")
    broadcast = docs.sparkSession.sparkContext.broadcast
    table = stored(shards(docs, n_shards), "shards", by="shard")
    n_words = table.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = int(n_words.agg(F.sum("n")).first()[0] or 0)
    bits = max(4, min(16, (words // RANGE_WORDS).bit_length()))
    steps: list[DataFrame] = []
    marks, sent = np.zeros(1 << slot_bits, np.uint8), None
    finer = min(FINE_BITS, 31 - slot_bits)
    shorter_bits, longest_bits = (np.zeros(1 << (slot_bits + finer - 3), np.uint8) for _ in range(2))
    step = last = 0
    while step < max(n_shards, last + n_shards):
        step += 1
        shard = table.where(F.col("shard") == (step - 1) % n_shards)
        steps.append(stored(_step_counts(shard, sent, step, n_shards, bits, threshold, block), f"step{step}", by="k"))
        if step > (LENGTHS - 1) * n_shards:  # only the longest phrases can still be active
            continue
        shorter = reduce(DataFrame.unionByName, steps[-n_shards:]).where((F.col("k") < LENGTHS) & (F.col("since") >= step - n_shards))
        fine = _reached(shorter, bits, threshold, slot_bits + finer)
        _mark(shorter_bits, fine)
        slots = fine >> finer
        new = slots[marks[slots] == 0]
        if len(new):
            marks[new], last = step, step
            if sent is not None:
                sent.unpersist()
            sent = broadcast(marks.copy())
    _mark(longest_bits, _reached(reduce(DataFrame.unionByName, steps).where(F.col("k") == LENGTHS), bits, threshold, slot_bits + finer))
    named = _named(table.coalesce(-(-words // TASK_WORDS) or 1), broadcast((shorter_bits, longest_bits)), block)
    return named.where(F.col("f") >= threshold), n_words


def _cut_after(n: int, k: int) -> tuple:
    """The first k words of a phrase of n words, and the rest."""
    return F.substring_index("phrase", " ", k), F.substring_index("phrase", " ", k - n)


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, n_shards: int = SHARDS, slot_bits: int = SLOT_BITS,
                 block: int = BLOCK) -> DataFrame:
    """docs (text, lang, ...) -> lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by score."""
    counted, n_words = phrase_counts(docs, threshold, n_shards, slot_bits, block)
    counted = stored(counted, "counted")
    phrases = counted.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    parts = counted.select("lang", F.col("phrase").alias("part"), "f")

    inner = [F.struct(_subphrase(n, i, m).alias("phrase"), F.lit(n).alias("of"))
             for n in range(3, LENGTHS + 1) for m in range(2, n) for i in range(n - m + 1)]
    covers = (phrases.select("lang", "a", F.explode(F.filter(F.array(*inner), lambda c: c["of"] == F.col("k"))["phrase"]).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    # only shorter phrases can lie in a longer one; those that do leave before their parts are looked up
    left = phrases.where(F.col("k") < LENGTHS).join(covers, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * cast(longer as decimal(20,0)) < {COVERED} * cast(a as decimal(20,0))")).drop("longer")
    left = left.unionByName(phrases.where(F.col("k") == LENGTHS))

    cuts = [F.struct(F.lit(k).alias("cut"), F.lit(side).alias("side"), _cut_after(n, k)[side].alias("part"), F.lit(n).alias("of"))
            for n in range(2, LENGTHS + 1) for k in range(1, n) for side in (0, 1)]
    halves = left.select("lang", "k", "phrase", "a", F.explode(F.filter(F.array(*cuts), lambda c: c["of"] == F.col("k"))).alias("c"))
    # both sides are plain shuffles of written rows, so the adaptive skew join splits a word of very many phrases
    halves = halves.select("lang", "phrase", "a", "c.cut", "c.side", "c.part").join(parts, ["lang", "part"])
    of = lambda cut, side: F.max(F.when((F.col("cut") == cut) & (F.col("side") == side), F.col("f")))
    cut_counts = [of(cut, side).alias(f"{'lr'[side]}{cut}") for cut in range(1, LENGTHS) for side in (0, 1)]
    both = halves.groupBy("lang", "phrase", "a").agg(*cut_counts)
    # 10^6 * a * a fits 38 digits up to a = 10^16
    score = "cast(cast(1000000 as decimal(7,0)) * cast(a as decimal(17,0)) * cast(a as decimal(17,0)) div (cast(l{0} as decimal(18,0)) * cast(r{0} as decimal(18,0))) as long)"
    scored = [F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(score.format(k)).alias("score"), F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
              for k in range(1, LENGTHS)]
    best = both.withColumn("c", F.least(*scored)).select("lang", "phrase", "a", "c.l", "c.r", "c.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(n_words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _subphrase(n: int, i: int, m: int):
    """Words i to i + m of a phrase of n words."""
    return F.substring_index(F.substring_index("phrase", " ", i + m), " ", -m)
