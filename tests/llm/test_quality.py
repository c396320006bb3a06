import itertools
import math
import zlib

import numpy as np
import pytest

from revops_spark.llm import quality as q
from revops_spark.llm import queries
from revops_spark.llm._shared import table


@pytest.fixture(scope="module")
def model(spark):
    d = "/root/testdata/sf0.1"
    return q.train(table(spark, d, "documents"), table(spark, d, "labels"),
                   meta_cols=queries.QUALITY_META)


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(1)
    model = q.FactorisationMachine(q._WORD_BUCKETS + 4)
    model.v = rng.standard_normal(model.v.shape).astype(np.float32) * 0.3
    model.w = rng.standard_normal(model.dim).astype(np.float32)
    model.w0 = 0.2
    index = np.array([3, 9, 100, q._WORD_BUCKETS, q._WORD_BUCKETS + 2], np.int32)
    value = rng.standard_normal(5).astype(np.float32)
    z = model.w0 + float(model.w[index] @ value) + sum(
        float(model.v[index[a]] @ model.v[index[b]]) * value[a] * value[b]
        for a, b in itertools.combinations(range(5), 2))
    assert model.score([(index, value)])[0] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-4)


def test_learns_a_pairwise_rule():
    """Label 1 where exactly one of two words occurs, which no linear model can tell."""
    make, rng = q.Features(0), np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(1500):
        a, b = (rng.random(2) < 0.5).tolist()
        rows.append(make.row(" ".join(["one"] * a + ["two"] * b + ["rest"]), []))
        labels.append(float(a != b))
    model = q.FactorisationMachine(make.dim)
    model.fit(rows, np.array(labels, np.float32), epochs=40)
    assert ((model.score(rows) > 0.5) == np.array(labels)).mean() > 0.98


def test_held_out_accuracy(spark, model):
    d = "/root/testdata/sf0.1"
    rows = q.score(table(spark, d, "documents"), model, meta_cols=queries.QUALITY_META).join(
        table(spark, d, "labels"), "doc_id").filter("held_out").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert len(bad) > 100
    assert sum(r.predicted for r in good) / len(good) > 0.99
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.97


def test_held_out_fold(spark):
    import zlib
    df = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    for r in df.withColumn("h", q.held_out()).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_odd_documents(odd, odd_docs, model):
    rows = q.score(odd_docs, model, meta_cols=queries.QUALITY_META).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    kept = q.accepted(odd_docs, model, meta_cols=queries.QUALITY_META)
    assert kept.schema == odd_docs.schema
    assert kept.count() == sum(r.predicted for r in rows)


def test_metadata_may_be_left_out(spark, odd_docs):
    labels = spark.createDataFrame([(110, 1, 0), (110, 0, 0), (111, 0, 0), (112, 2, 0), (None, 1, 0),
                                    (113, None, 0)], "doc_id long, quality int, toxic int")
    model = q.train(odd_docs, labels)
    assert q.score(odd_docs, model).count() == odd_docs.count()


def test_without_labels_scores_are_even(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = q.train(odd_docs, labels)
    scores = [r.score for r in q.score(odd_docs, model).collect()]
    assert all(s == pytest.approx(0.5, abs=0.05) for s in scores)
    assert q.score(no_docs, q.train(no_docs, labels)).collect() == []


def test_the_training_bound_holds(spark, monkeypatch):
    d, seen = "/root/testdata/sf0.01", []
    real = q.FactorisationMachine.fit
    monkeypatch.setattr(q.FactorisationMachine, "fit",
                        lambda self, rows, labels, **k: (seen.append(len(rows)), real(self, rows, labels, **k)))
    q.train(table(spark, d, "documents"), table(spark, d, "labels"), max_rows=50)
    assert seen == [50]


def test_the_sample_reaches_the_driver_in_parts(spark, monkeypatch):
    """No whole sample is collected, and a model of rows fetched in parts is that of the rows."""
    frame = type(spark.range(0))
    for name in ("toArrow", "collect", "toPandas"):
        monkeypatch.setattr(frame, name, lambda self: pytest.fail("collected whole"))
    texts = {i: " ".join(f"w{(i * k) % 31}" for k in range(1 + i % 9)) for i in range(60)}
    docs = spark.createDataFrame([*texts.items(), (3, texts[3])], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    model = q.train(docs, labels)
    known = [i for i in texts if zlib.crc32(str(i).encode()) % 5]
    make, want = q.Features(0), q.FactorisationMachine(model.dim)
    want.fit([make.row(texts[i], []) for i in known], np.array([i % 2 for i in known], np.float32))
    assert np.array_equal(model.w, want.w) and np.array_equal(model.v, want.v) and model.w0 == want.w0
