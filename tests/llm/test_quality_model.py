"""The classifier: held-out accuracy, the linear-time identity, and odd rows."""

import zlib
from itertools import combinations

import numpy as np
import pytest

from clearwell.llm import quality_model as Q
from clearwell.llm.common import table
from tests.llm.cases import documents, texts

FOLDER = "/root/testdata/sf0.01"
QUICK = Q.Settings(documents=300, buckets=1 << 10, epochs=3)


@pytest.fixture(scope="module")
def model(spark):
    return Q.fit(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    rows = Q.quality(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in judged]) >= 0.97
    assert np.mean([p for p, y in judged if y == 1]) >= 0.99


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id AS string)) % 3 = 1, 1 - quality, quality) AS quality")
    changed = docs.selectExpr("doc_id", "text", "'xx' AS lang", "doc_id % 2 AS source", "0L AS n_chars")
    one, two = Q.fit(docs, labels, QUICK), Q.fit(changed, flipped, QUICK)
    assert one.bias == two.bias and (one.weights == two.weights).all() and (one.factors == two.factors).all()


def test_sum_of_squares_identity(model):
    text = "some words, and MORE words!! 123 ### here"
    at, value, structure = Q.inputs(text, model.buckets)
    at = np.concatenate([at, np.arange(model.buckets, len(model.weights))])
    x = np.concatenate([value, Q._scaled(structure, model)]).astype(float)
    pairs = sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i, j in combinations(range(len(at)), 2))
    plain = 1 / (1 + np.exp(-(model.bias + model.weights[at] @ x + pairs)))
    assert Q.score(text, model) == pytest.approx(plain, abs=1e-5)


def test_edge_rows(spark, model):
    docs = documents(spark)
    rows = Q.scored(docs, model).collect()
    assert len(rows) == len(texts())
    by_text = {}
    for r in rows:
        assert 0 <= r.score <= 1
        assert by_text.setdefault(r.text or "", r.score) == r.score
    kept = Q.accepted(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r.score >= 0.5 for r in rows)
    assert Q.quality(documents(spark, []), table(spark, FOLDER, "labels"), QUICK).collect() == []


def test_without_labels_or_with_one_class(spark):
    docs = documents(spark)
    none = spark.createDataFrame([(10, None, 1), (None, 1, 0), (11, 5, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in Q.quality(docs, none, QUICK).collect()} == {0.5}
    good = spark.createDataFrame([(10, 1, 0), (10, 1, 0), (30, 1, 0), (31, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in Q.quality(docs, good, QUICK).collect()} == {1}
