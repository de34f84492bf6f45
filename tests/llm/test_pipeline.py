"""Each stage of the pipeline beside a plain version, on what its predecessor kept."""

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tradewind.llm import bpe, mixing

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs))
    return out


def test_stages_return_documents(kept):
    columns = kept[0][1].columns
    assert [n for n, _ in kept[1:]] == ["quality", "line_dedup", "near_duplicates", "mix_sources", "tokens"]
    assert all(df.columns == columns for _, df in kept[1:-1])
    assert all(df.count() for _, df in kept)


def test_quality_keeps_trusted(spark, kept):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = labels.where("quality = 1")
    before, after = (df.join(good, "doc_id", "left_semi").count() for _, df in kept[:2])
    assert after >= 0.9 * before
    bad = labels.where("quality = 0")
    before, after = (df.join(bad, "doc_id", "left_semi").count() for _, df in kept[:2])
    assert after <= 0.3 * before


def test_line_dedup_stage(kept):
    before = {r["doc_id"]: r["text"] for r in kept[1][1].collect()}
    want = brute.dedup_lines(before)
    want = {d: t for d, t in want.items() if brute.words(t) or not brute.words(before[d])}
    got = {r["doc_id"]: r for r in kept[2][1].collect()}
    assert {d: r["text"] for d, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_near_duplicates_stage(kept):
    before = {r["doc_id"]: r["text"] for r in kept[2][1].collect()}
    found = brute.jaccard_components(before, 5, 80)
    assert {r["doc_id"] for r in kept[3][1].collect()} == {d for d, (_, c) in found.items() if c == d}


def test_mix_stage(kept):
    times = {r["doc_id"]: r["times"] for r in mixing.mix(kept[3][1]).collect()}
    got = {r["doc_id"]: r["count"] for r in kept[4][1].groupBy("doc_id").count().collect()}
    assert got == {d: t for d, t in times.items() if t}


def test_tokens_stage(kept):
    own = Tokenizer.from_file(bpe.VOCABULARY)
    texts = {r["doc_id"]: r["text"] for r in kept[4][1].collect()}
    rows = kept[5][1].collect()
    assert len(rows) == kept[4][1].count()
    for r in rows:
        ids = own.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and out.count() > 0
