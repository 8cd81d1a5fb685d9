"""The pipeline: each stage on what the one before kept, against plain versions, and on odd inputs."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postmill.llm import near, private, quality
from tests.llm.test_operators import DOCS, odd_rows, plain_components, plain_measures

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_stages_keep_the_columns(stages):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == corpus_pipeline.COLUMNS


def test_quality_drops_what_fails_the_counts_and_keeps_clean_rows(spark, stages):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id for r in stages["quality"].collect()}
    for i, t in docs.items():
        n, _, _, _, repeated = plain_measures(t or "")
        assert not (i in kept and (n < 10 or 100 * repeated > 20 * n))
    good = [r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect() if plain_measures(docs[r.doc_id])[0] >= 10]
    assert sum(i in kept for i in good) > 0.9 * len(good)


def test_one_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages["quality"].collect()]
    want = plain_components(before, 5)[0]
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == {i for i, c in want.items() if i == c}


def test_rows_alike_in_id_are_one_document(spark):
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words, "en", "a", 9), (1, words, "en", "a", 9), (2, words + " more", "en", "a", 9), (3, "other text", "en", "b", 1), (3, "another text", "en", "b", 1), (None, "x", "en", "b", 1), (None, "x", "en", "b", 1)]
    got = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, DOCS), SF).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in got)) == [(0, "x"), (0, "x"), (1, words), (3, "another text")]


def test_nothing_personal_is_left(stages):
    after = {r.doc_id: r.text for r in stages["private_data"].collect()}
    assert set(after) == {r.doc_id for r in stages["near_duplicates"].collect()}
    assert not any(private.base_spans(t) for t in after.values())


def test_mix_only_drops_and_repeats(stages):
    before = {r.doc_id: r.text for r in stages["private_data"].collect()}
    after = stages["source_mix"].collect()
    assert all(before[r.doc_id] == r.text for r in after) and max(Counter(r.doc_id for r in after).values()) <= 2


def test_tokens_of_every_row(stages):
    rows = stages["sentencepiece"].collect()
    assert len(rows) == stages["source_mix"].count() and all(r.round_trip for r in rows)


def test_run_gives_the_same_rows(spark, stages):
    key = lambda d: sorted((r.doc_id, r.n_tokens) for r in d.select("doc_id", "n_tokens").collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages["sentencepiece"])


def test_stages_on_odd_rows_and_none(spark):
    odd = spark.createDataFrame(odd_rows(), DOCS).withColumn("kept", F.lit(1)).withColumn("base", F.lit(1))
    for docs in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).count()
    assert quality.MIN_WORDS == 10 and near.PERCENT == 80
