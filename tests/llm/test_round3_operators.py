"""License scan, collocations and hard negatives against brute force, and on edge cases."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from edustar.llm import collocations, hard_negatives, license_scan, queries
from edustar.llm.license_scan import Notice, Place, Scanner
from tests.llm.conftest import EDGE

SF = "/root/testdata/sf0.01"


# -- 11: license scan ---------------------------------------------------------------------------------

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def all_fits(words, notice):
    """Every span of whole words within the notice's edits."""
    out = []
    for i in range(len(words)):
        for j in range(i, len(words)):
            span = " ".join(words[i:j + 1])
            if len(span) > len(notice.text) + notice.edits:
                break
            d = edits(span, notice.text)
            if d <= notice.edits:
                out.append((d, i, j))
    return out


def chosen(fits):
    """Fewest edits, then leftmost, then shortest, without overlaps."""
    out = []
    for d, i, j in sorted(fits):
        if all(j < a or b < i for _, a, b in out):
            out.append((d, i, j))
    return out


def mutated(rng, text, n):
    for _ in range(n):
        i, kind = rng.randrange(len(text)), rng.randrange(4)
        text = text[:i] + ("" if kind == 0 else rng.choice("aeéx ") + (text[i:] if kind == 1 else text[i + 1:])) + (text[i + 1:] if kind == 0 else "")
    return text


def test_places_equal_brute_force():
    rng = random.Random(11)
    notices = [Notice("a", "mit license", 2), Notice("b", "public domain work", 3), Notice("c", "free of charge", 1), Notice("d", "x y", 0), Notice("d", "a a", 0)]
    scanner = Scanner(notices)
    seen = 0
    for _ in range(250):
        parts = []
        for _ in range(rng.randint(0, 6)):
            n = rng.choice(notices)
            parts.append(mutated(rng, n.text, rng.randint(0, n.edits + 1)) if rng.random() < 0.7 else rng.choice(["the", "mit", "x", "a a a", "é", "work"]))
        _, words = license_scan.words_of(" ".join(parts))
        got = scanner.places(words)
        text = [w.decode() for w in words]
        want = []
        for k, n in enumerate(notices):
            fits = all_fits(text, n)
            want += [Place(i, j, k, d) for d, i, j in (fits if n.edits == 0 else chosen(fits))]
        assert got == sorted(want), text
        seen += len(want)
    assert seen > 300


def test_every_seed_layout_is_found():
    """Any set of edits leaves a piece whole: single edits at every place of a notice."""
    notice = Notice("a", "licensed under terms", 1)
    scanner = Scanner([notice])
    for i in range(len(notice.text)):
        for changed in (notice.text[:i] + notice.text[i + 1:], notice.text[:i] + "q" + notice.text[i + 1:], notice.text[:i] + "q" + notice.text[i:]):
            _, words = license_scan.words_of("so " + changed + " so")
            want = all_fits([w.decode() for w in words], notice)
            assert bool(scanner.places(words)) == bool(want), changed


def test_spans_are_code_points_of_the_text():
    text = "É? Released -- under\nthe M1T License; ok"
    raw, words = license_scan.words_of(text)
    scanner = Scanner([Notice("mit", "released under the mit license", 2)])
    [place] = scanner.places(words)
    [(a, b)] = license_scan.spans(raw, [place])
    assert text[a:b] == "Released -- under\nthe M1T License" and place.edits == 1


def test_license_query_against_plain_counting(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_license_scan"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
    labelled = 0
    for doc_id, text in docs:
        words = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        places = sorted((i, k) for k, p in phrases.items() for i in range(len(words)) if words[i:i + len(p)] == p)
        r = got[doc_id]
        base = sorted({k for _, k in places})
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(places), ",".join(base))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(base) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
        labelled += bool(r["labels"])
    assert 0 < labelled < len(docs) / 5


def test_license_edges(spark, frame):
    got = license_scan.scan_documents(frame(EDGE)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in EDGE)
    assert all((r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, None, "", 0.0) for r in got)
    assert license_scan.scan_documents(frame([])).collect() == []
    hot = license_scan.scan_documents(frame([(1, "MIT license " * 40_000), (2, "license " * 60_000)])).orderBy("doc_id").collect()
    assert (hot[0]["n_base"], hot[0]["last_word"], hot[1]["n_base"]) == (40_000, 79_998, 0)


# -- 12: collocations ---------------------------------------------------------------------------------

def brute_collocations(rows, threshold, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {p: a for p, a in f.items() if a >= threshold and len(p[1]) > 1}
    out = {}
    for (lang, p), a in cand.items():
        score, k, left, right = min((10 ** 6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        if any(q != p and lang2 == lang and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= 50 * a
               for (lang2, q), b in cand.items() if len(q) > len(p)):
            continue
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s)
                  for lang, rows in out.items() for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def test_collocations_equal_brute_force(spark):
    rng = random.Random(12)
    vocabulary = ["alpha", "beta", "gamma", "Delta", "é", "x-y", "ö", "w" * 70] + [f"r{i}" for i in range(30)]
    def text():
        out = []
        for _ in range(rng.randint(0, 60)):
            out.append(rng.choices(vocabulary, weights=[9, 8, 7, 6, 5, 4, 3, 2] + [0.3] * 30)[0] if rng.random() < 0.8 else "new york city")
            out.append(rng.choice([" ", "  ", " \t", " ", ". ", ",", "\n", " ", " ", "\r\n", " "]))
        return "".join(out)
    rows = [(rng.choice(["en", "de", "und", None, ""]), text() if i % 17 else None) for i in range(160)]
    table = spark.createDataFrame([(lang, t, 1.0) for lang, t in rows], "lang string, text string, score double").repartition(3)
    for threshold, shards in ((10, 3), (3, 4), (25, 1)):
        got = collocations.collocations(table, threshold=threshold, top=40, n_shards=shards)
        assert sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())) == brute_collocations(rows, threshold, 40)


def test_phrases_late_in_the_cycle_are_counted_whole(spark):
    """A word that reaches the threshold in the last shard only, and slots so few that hashes collide all the time."""
    rows = [("en", f"rare pair {i} filler{i % 7} words") for i in range(24)] + [("en", "a b c d e")] * 12
    table = spark.createDataFrame(rows, "lang string, text string")
    want = brute_collocations(rows, 10, 50)
    assert {w[2] for w in want} >= {"rare pair", "a b c"}
    for bits in (22, 3):
        got = collocations.collocations(table, n_shards=5, slot_bits=bits)
        assert sorted(map(tuple, got.collect())) == want


def test_long_pieces_and_small_blocks(spark):
    rows = [("en", "one two three four " * 400 + "\n" + "z" * 5000), ("en", "\n".join(["one two"] * 300)), ("de", " ")]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), block=64)
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 10, 2000)


def test_collocation_edges(spark, frame):
    assert collocations.collocations(frame([])).collect() == []
    got = collocations.collocations(frame(EDGE)).collect()
    assert {r["phrase"] for r in got} == {"long long long"} and got[0]["a"] == 59_998


def test_scores_past_64_bits(spark):
    a = 3_000_000_007
    got = spark.sql(f"select cast(1000000 as decimal(7,0)) * cast({a}L as decimal(17,0)) * cast({a}L as decimal(17,0)) div "
                    f"(cast({a + 5}L as decimal(18,0)) * cast({a + 9}L as decimal(18,0))) as s").first()["s"]
    assert got == 10 ** 6 * a * a // ((a + 5) * (a + 9))


# -- 13: hard negatives -------------------------------------------------------------------------------

def brute_negatives(rows, every=100):
    table = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        y = [int(np.floor(256 * float(c))) for c in x]
        table[vec_id] = max(table.get(vec_id, (label, y)), (label, y), key=lambda r: (r[0], np.array(r[1], np.int32).tobytes()))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, (label, q) in table.items():
        if a % every:
            continue
        scored = sorted((-dot(q, y), i, own) for i, (own, y) in table.items() if i != a)
        for p, i, own in [s for s in scored if s[2] == label][:5]:
            near = [(n, j) for n, j, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(a, i, r, j, -p, -n) for r, (n, j) in enumerate(near, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("kind", ["clusters", "lengths", "ties", "wide"])
def test_negatives_equal_brute_force(spark, kind):
    rng = np.random.default_rng(13)
    n, dim = 700, 6
    x = rng.normal(size=(n, dim))
    if kind == "clusters":
        x = rng.normal(size=(9, dim))[rng.integers(0, 9, n)] + 0.2 * x
    elif kind == "lengths":
        x *= np.exp(rng.normal(size=(n, 1)) * 2)
    elif kind == "ties":
        x = np.round(x) / 4
    else:
        x *= 1e6  # products pass 2^53
    rows = [(int(i), [float(c) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    want = brute_negatives(rows, every=20)
    assert len(want) > 100
    for bucket_bytes in (8 * dim * 50, 8 << 20):  # 14 buckets, and one
        got = hard_negatives.hard_negatives(table, every=20, bucket_bytes=bucket_bytes)
        assert sorted(map(tuple, got.select(COLUMNS).collect())) == want


def test_pruning_keeps_all_that_reach_the_score():
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(size=(800, 8)) * np.exp(rng.normal(size=(800, 1))))
    bucket = hard_negatives.Bucket(np.arange(800), np.zeros(800, int), x)
    searched = 0
    for q in x[:60]:
        scores = x @ q
        at_least = float(np.sort(scores)[-6])
        rows = bucket.candidates(q, float(np.sqrt(q @ q)), at_least)
        assert set(np.flatnonzero(scores >= at_least)) <= set(rows.tolist())
        searched += len(rows)
    assert searched < 60 * 800 / 2


def test_negative_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, None, 1), (200, [nan, 1.0], 1), (300, [inf, 1.0], 1), (400, [None, 1.0], 1), (500, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
            (1, [1.0, 0.5], 2), (1, [1.0, 0.5], 2), (2, [0.9, 0.5], 2), (2, [0.9, 0.4], 2), (3, [0.9, 0.4], 1), (4, [1.0], 2), (5, [], 2), (600, [-1.0, 0.0], 1), (700, [0.0, 0.0], 4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    padded = [(i, x if x is None else x + [0.0] * (2 - len(x)), label) for i, x, label in rows]
    assert sorted(map(tuple, hard_negatives.hard_negatives(table).select(COLUMNS).collect())) == brute_negatives(padded)
    assert hard_negatives.hard_negatives(table.limit(0)).collect() == []


def test_the_last_scan_names_few_phrases_below_the_threshold(spark, monkeypatch):
    named, scan = [], collocations._named
    monkeypatch.setattr(collocations, "_named", lambda *a: named.append(scan(*a)) or named[-1])
    words = [f"common{i}" for i in range(40)] * 12 + [f"rare{i}" for i in range(2_000)]
    random.Random(15).shuffle(words)
    docs = spark.createDataFrame([(". ".join(words[i::50]), "en") for i in range(50)], "text string, lang string")
    counted, _ = collocations.phrase_counts(docs, slot_bits=8)
    assert {(r["phrase"], r["f"]) for r in counted.collect()} == {(f"common{i}", 12) for i in range(40)}
    assert named[0].count() < 160  # of 2,000 rare words a 256th part each slot that holds a common one would let pass


def test_bits_of_hashes():
    table = np.zeros(1 << 5, np.uint8)
    key = np.random.default_rng(16).integers(0, 1 << 64, 300, np.uint64)
    collocations._mark(table, (key[:100] >> np.uint64(56)).astype(np.int32))
    want = np.isin(key >> np.uint64(56), key[:100] >> np.uint64(56))
    assert (collocations._marked(table, key) == want).all() and want[:100].all() and not want.all()


def test_the_setting_for_shuffle_files_is_put_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([("a b c. a b c", "en")], "text string, lang string")
    collocations.phrase_counts(docs, threshold=2)
    assert spark.conf.get(name) == before
