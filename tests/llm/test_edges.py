"""Every operator on an empty table and on nulls, ties, repeats, empty and very long texts, extra columns."""
import public_tokenizers as P
import pytest

import corpus_pipeline
from edustar.llm import (fingerprint, html_text, order_minhash, packing, piece_sampling, pq_dedup, quality, secret_scan,
                         token_attribution, toxicity)
from tests.llm.conftest import EDGE

LABELS = [(1, 1), (3, 1), (3, 0), (4, 0), (6, 0), (7, 1), (None, 1), (8, None)]


def labels(spark):
    return spark.createDataFrame([(i, 1, t) for i, t in LABELS], "doc_id long, quality int, toxic int")


PER_ROW = {
    "quality": lambda s, d: quality.classify(d),
    "secrets": lambda s, d: secret_scan.scan_documents(d),
    "fingerprint": lambda s, d: fingerprint.edit_likeness(d),
    "sketch": lambda s, d: fingerprint.fingerprint_documents(d),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "near_dedup": lambda s, d: order_minhash.near_duplicates(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, frame, name):
    got = PER_ROW[name](spark, frame(EDGE)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in EDGE)
    assert PER_ROW[name](spark, frame([])).collect() == []


def test_sections_and_samples(spark, frame):
    docs = frame(EDGE)
    got = token_attribution.attribute_lines(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert {r["doc_id"] for r in got} == {i for i, _ in EDGE}
    assert token_attribution.attribute_lines(frame([]), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []
    got = piece_sampling.segmentations(docs, P.path("piece_bpe_32k.model")).collect()
    assert all(r["round_trip"] for r in got)
    assert {r["doc_id"] for r in got} == {i for i, t in EDGE if t}
    assert piece_sampling.segmentations(frame([]), P.path("piece_bpe_32k.model")).collect() == []


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (None, None, "<p>a", 2), (2, "v", "", 3), (2, "v", "", 3)], "page_id long, url string, html string, text int")
    got = html_text.extract(pages).collect()
    assert len(got) == 4 and all(r["text"] == "" and r["n_chars"] == 0 for r in got if r["page_id"])
    assert html_text.extract(pages.limit(0)).collect() == []


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [5.0, 0.1]), (None, [1.0, 0.01]), (9, [0.0, 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in pq_dedup.near_duplicates(v).collect())
    assert got == [(0, 3, 7, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
                   (7, 3, 7, True), (7, 3, 7, True), (8, 3, 7, False), (9, 0, 9, True)]
    assert pq_dedup.near_duplicates(v.limit(0)).collect() == []


def test_pipeline_stages(spark, frame, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (EDGE, []):
        docs = frame(rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, str(tmp_path))
            assert got.columns == docs.columns, name
            got.write.mode("overwrite").parquet(f"{tmp_path}/{name}{len(rows)}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{len(rows)}")
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert len({(r["doc_id"], r["start"], r["sequence_id"]) for r in pieces}) >= docs.count()


def test_packing_edges(spark, frame):
    got = packing.pack(frame(EDGE), P.path("word_bpe_49k.json")).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 2) == 1
    assert packing.pack(frame([]), P.path("word_bpe_49k.json")).collect() == []
