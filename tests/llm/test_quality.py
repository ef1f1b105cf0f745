"""The quality classifier: held-out accuracy, the solver, and the plain cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchledger.llm import quality, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    df = queries.QUERIES["op6_quality"](spark, FOLDER)
    return {r.doc_id: r for r in df.collect()}


def test_held_out_rows_follow_the_checksum(scored):
    assert len(scored) == 1000
    for i, r in scored.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_held_out_documents_are_told_apart(spark, scored):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    unseen = [(scored[r.doc_id], r.quality) for r in labels if scored[r.doc_id].held_out]
    good = [s.predicted for s, q in unseen if q == 1]
    poor = [s.predicted for s, q in unseen if q == 0]
    assert np.mean(good) > 0.9 and np.mean(poor) < 0.15


def test_reruns_agree(spark, scored):
    again = queries.QUERIES["op6_quality"](spark, FOLDER).collect()
    assert all(r.score == scored[r.doc_id].score for r in again)


def test_features_of_chunks_are_those_of_the_whole(monkeypatch):
    text = " ".join(f"word{i}!" for i in range(900)).encode()
    whole = quality.features(text)
    monkeypatch.setattr(quality, "_CHUNK", 100)
    assert np.array_equal(quality.features(text), whole)
    assert np.array_equal(whole, np.unique(whole))
    assert len(quality.features(None)) == len(quality.features(b"")) > 0


def test_dual_coordinate_descent_reaches_the_optimum():
    random = np.random.default_rng(0)
    rows = [np.sort(random.choice(30, 8, replace=False)) for _ in range(60)]
    values = [random.normal(size=8) for _ in rows]
    labels = np.where(random.random(60) < 0.5, 1.0, -1.0)
    w, b = quality.dual_coordinate_descent(rows, values, labels, passes=3000)
    share = np.where(labels > 0, (labels > 0).mean(), (labels < 0).mean())
    limits = 0.5 / share

    def loss(w, b):
        slack = [max(0, 1 - y * (w[r] @ v + b)) for r, v, y in zip(rows, values, labels)]
        return 0.5 * (w @ w + b * b) + limits @ slack

    best = loss(w, b)
    for _ in range(200):
        assert loss(w + random.normal(0, 1e-2, len(w)) * (np.arange(len(w)) < 30), b) >= best - 1e-3


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def small(documents, prose):
    return documents(
        [prose(i, 40) if i % 2 else "@@ " * 30 + str(i) for i in range(80)] + [None, "", "@@"]
    )


def test_small_corpus_with_nulls_repeats_and_clashes(spark, documents, prose):
    docs = small(documents, prose)
    rows = [(i, i % 2, 0) for i in range(80)] + [(1, 0, 0), (None, 1, 0), (3, None, 0), (999, 1, 0)]
    model = quality.train(docs, labels_of(spark, rows))
    odd = docs.union(docs).withColumn("score", F.lit("x")).withColumn("places", F.lit(1))
    got = quality.score_documents(odd, model)
    assert got.columns == [*odd.columns, "_score", "predicted"]
    found = [(r.doc_id, r._score, r.predicted) for r in got.collect()]
    assert len(found) == 166 and len(set(found)) == 83
    assert np.mean([p == i % 2 for i, _, p in found if i < 80]) > 0.95
    kept = quality.keep_predicted(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == sum(p for *_, p in found)


@pytest.mark.parametrize("rows", [[], [(i, 1, 0) for i in range(40)], [(i, 0, 0) for i in range(40)]])
def test_without_both_classes_nothing_is_rejected(spark, documents, prose, rows):
    docs = small(documents, prose)
    model = quality.train(docs, labels_of(spark, rows))
    assert quality.keep_predicted(docs, model).count() == docs.count()


def test_empty_documents(spark, documents, prose):
    docs = small(documents, prose).limit(0)
    model = quality.train(docs, labels_of(spark, [(1, 1, 0), (2, 0, 0)]))
    assert quality.score_documents(docs, model).collect() == []


def test_fit_is_bounded_by_ids(spark, documents, prose):
    docs = small(documents, prose)
    known = quality.training_labels(labels_of(spark, [(i, i % 2, 0) for i in range(80)]))
    assert quality.fit_sample(docs.union(docs), known, 10).count() == 10
