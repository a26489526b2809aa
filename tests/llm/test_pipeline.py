"""The pipeline, each stage judged on its own input."""

import pytest

import corpus_pipeline
from clearwell.llm import decontamination, quality_model
from clearwell.llm.common import table
from tests.llm import test_line_dedup, test_minhash_dedup

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, found = table(spark, FOLDER, "documents"), []
    found.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs)
    return found


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality_drops_what_the_model_rejects(spark, steps):
    model = quality_model.fit(steps[0], table(spark, FOLDER, "labels"))
    assert rows(steps[1]) == [r for r in rows(steps[0]) if quality_model.score(r[1], model) >= 0.5]
    good = {r.doc_id for r in table(spark, FOLDER, "labels").where("quality = 1").collect()}
    assert good <= {r[0] for r in rows(steps[1])}


def test_lines(steps):
    gone = test_line_dedup.brute(rows(steps[1]))
    assert gone
    want = [
        (id_, "\n".join(x for k, x in enumerate(text.split("\n")) if (id_, k) not in gone)) for id_, text in rows(steps[1])
    ]
    assert rows(steps[2]) == want
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_copies(steps):
    kept = {r[0] for r in test_minhash_dedup.brute(rows(steps[2]), 5, 80) if r[3]}
    assert rows(steps[3]) == [r for r in rows(steps[2]) if r[0] in kept]


def test_benchmark(spark, steps):
    items = [decontamination.item_words(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    left = {r[0] for r in rows(steps[4])}
    for id_, text in rows(steps[3]):
        words = decontamination.item_words(text)
        whole = " " + b" ".join(words).decode() + " "
        if any(f" {b' '.join(item).decode()} " in whole for item in items):
            assert id_ not in left
        elif not any(set(zip(i, i[1:], i[2:], strict=False)) & set(zip(words, words[1:], words[2:], strict=False)) for i in items):
            assert id_ in left


def test_packing(steps):
    pieces = steps[5].collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in rows(steps[4])}
    assert max(r.offset + r.length for r in pieces) <= 4096


def test_run(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).drop("sequence_id", "offset").collect())) == sorted(
        map(tuple, steps[5].drop("sequence_id", "offset").collect())
    )
