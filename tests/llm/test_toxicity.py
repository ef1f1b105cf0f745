"""The classifier chain: held-out accuracy, later links, and the plain cases."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from watchledger.llm import queries, toxicity

FOLDER = "/root/testdata/sf0.1"


def test_held_out_documents_are_told_apart(spark):
    rows = queries.QUERIES["op4_toxicity"](spark, FOLDER).collect()
    scored = {r.doc_id: r for r in rows}
    assert len(rows) == len(scored) == 10_000
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    unseen = [(scored[r.doc_id].predicted, r.toxic) for r in labels if scored[r.doc_id].held_out]
    toxic = [p for p, t in unseen if t == 1]
    clean = [p for p, t in unseen if t == 0]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.01


def rows_of(*words, size=4):
    return toxicity.Rows([np.array(w, np.int64) for w in words], size)


def test_logistic_fit_is_at_its_optimum():
    random = np.random.default_rng(0)
    rows = rows_of(*[np.flatnonzero(random.random(6) < 0.4) for _ in range(80)], size=6)
    earlier = random.random((80, 2))
    labels = (random.random(80) < 0.4).astype(float)
    model = toxicity.fit_linear(rows, earlier, labels)
    p = toxicity.predict(model, rows, earlier)
    slope = rows.back(p - labels) + toxicity.PENALTY * model.words
    assert np.abs(slope).max() < 1e-2
    assert np.abs(earlier.T @ (p - labels) + toxicity.PENALTY * model.earlier).max() < 1e-2
    assert abs((p - labels).sum()) < 5e-2


def test_a_later_category_uses_the_earlier_one():
    # The second category follows the first one's words through its probability.
    words = [[i // 3 % 3] for i in range(300)]
    first = np.array([w[0] == 0 for w in words], float)
    chain = toxicity.fit_chain(rows_of(*words), np.column_stack([first, first]))
    assert [len(m.earlier) for m in chain] == [0, 1]
    assert chain[1].earlier[0] > 0.5
    found = toxicity.predict_chain(chain, rows_of([0], [1], []))
    assert found.shape == (3, 2) and found[0].min() > 0.9 > 0.1 > found[1].max()


def categories():
    return {
        "rude": F.col("quality") == 0,
        "toxic": F.col("toxic") == 1,
        "never": F.lit(False),
    }


def corpus(spark, documents, prose):
    texts = [
        f"{prose(i, 30)} {'idiot' if i % 4 == 0 else ''} {'meh' if i % 3 == 0 else ''}" for i in range(240)
    ]
    labels = [(i, int(i % 3 != 0), int(i % 4 == 0)) for i in range(240)]
    labels += [(None, 1, 1), (999, 1, 1), (4, None, None), (4, 1, 0)]
    docs = documents([*texts, None, "", "idiot " * 4000])
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_small_corpus_with_nulls_repeats_and_clashes(spark, documents, prose, scratch):
    docs, labels = corpus(spark, documents, prose)
    chain = toxicity.train(docs, labels, categories(), vocabulary=50, scratch=scratch)
    assert {"idiot", "meh"} <= set(chain.words) and len(chain.words) <= 50
    odd = docs.union(docs).withColumn("toxic", F.lit("x")).withColumn("probabilities", F.lit(1))
    got = toxicity.score_documents(odd, chain)
    assert got.columns == [*odd.columns, "rude", "_toxic", "never"]
    rows = got.collect()
    assert len(rows) == 486 and len({(r.doc_id, r.rude, r._toxic) for r in rows}) == 243
    assert max(r.never for r in rows) < 1e-6
    known = [r for r in rows if r.doc_id < 240]
    assert np.mean([(r._toxic > 0.3) == (r.doc_id % 4 == 0) for r in known]) > 0.97
    assert np.mean([(r.rude > 0.3) == (r.doc_id % 3 == 0) for r in known]) > 0.97
    assert next(r for r in rows if r.doc_id == 242)._toxic > 0.3


def test_empty_tables(spark, documents, prose, scratch):
    docs, labels = corpus(spark, documents, prose)
    chain = toxicity.train(docs, labels.limit(0), categories(), scratch=scratch)
    assert {r.toxic for r in toxicity.score_documents(docs, chain).collect()} == {0.0}
    chain = toxicity.train(docs, labels, categories(), scratch=scratch)
    assert toxicity.score_documents(docs.limit(0), chain).collect() == []


# -- from texts to scores, in plain numpy --------------------------------------


def brute_features(text):
    words = set(re.findall(r"[^\W_]+", (text or "").lower()))
    found = set(words)
    for size in (4, 6):
        for start in {w[:size] for w in words if len(w) > size}:
            n = sum(len(w) > size and w.startswith(start) for w in words)
            found |= {f"{start}*"} | {f"{start}*{k}" for k in (2, 3, 4) if k <= n}
    return found


def brute_fit(x, y):
    """Newton's method on the dense matrix, to the end."""
    if y.all() or not y.any():
        return np.append(np.zeros(x.shape[1]), 30.0 if y.any() else -30.0)
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.append(np.ones(x.shape[1]), 1e-6)
    w = np.zeros(x1.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x1 @ w))
        step = np.linalg.solve((x1.T * (p * (1 - p))) @ x1 + np.diag(ridge), x1.T @ (p - y) + ridge * w)
        w -= step / max(1.0, np.abs(step).max())
    return w


def brute_scores(docs, labels, vocabulary, least):
    """(poor, toxic) of every document; labels are (doc_id, poor, toxic)."""
    known = {}
    for doc_id, *flags in labels:
        if zlib.crc32(str(doc_id).encode()) % 4 != 2:
            known[doc_id] = np.maximum(known.get(doc_id, 0), flags)
    seen = {d: brute_features(t) for d, t in docs}
    ids = sorted(d for d in seen if d in known)
    y = np.array([known[d] for d in ids], float)
    best = {}
    for word in set().union(*(seen[d] for d in ids)):
        has = np.array([word in seen[d] for d in ids], float)
        if has.sum() >= least:
            spread = has.sum() * (len(ids) - has.sum()) * y.sum(0) * (len(ids) - y.sum(0))
            off = len(ids) * (has @ y) - has.sum() * y.sum(0)
            best[word] = max(o * o / s if s else 0.0 for o, s in zip(off, spread))
    words = sorted(best, key=lambda w: (-best[w], w))[:vocabulary]
    x = np.array([[w in seen[d] for w in words] for d in ids], float)
    whole = np.array([[w in seen[d] for w in words] for d, _ in docs], float)
    fold, made = np.arange(len(ids)) % 3, []
    for j in range(2):
        w = brute_fit(x, y[:, j])
        made.append(1 / (1 + np.exp(-(whole @ w[:-1] + w[-1]))))
        unseen = np.zeros(len(ids))
        for k in range(3):
            part = brute_fit(x[fold != k], y[fold != k, j])
            unseen[fold == k] = 1 / (1 + np.exp(-(x[fold == k] @ part[:-1] + part[-1])))
        x, whole = np.column_stack([x, unseen]), np.column_stack([whole, made[-1]])
    return {d: (a, b) for (d, _), a, b in zip(docs, *made)}


def test_scores_match_brute_force_from_the_text_on(spark, scratch):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    poor, toxic = F.col("quality") == 0, F.col("toxic") == 1
    chain = toxicity.train(
        docs, labels, {"poor": poor, "toxic": toxic}, vocabulary=150, least_texts=4, scratch=scratch
    )
    got = {r.doc_id: (r.poor, r.toxic) for r in toxicity.score_documents(docs, chain).collect()}
    rows = labels.select("doc_id", poor.cast("int"), toxic.cast("int")).collect()
    want = brute_scores([tuple(r) for r in docs.collect()], [tuple(r) for r in rows], 150, 4)
    assert got.keys() == want.keys() and len(got) >= 200
    for d, pair in want.items():
        assert got[d] == pytest.approx(pair, abs=0.01), d
