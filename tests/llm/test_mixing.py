"""Mixing: targets, repeats and the cases without words, sources or ids."""

import pytest
from pyspark.sql import functions as F

from watchledger.llm import mixing


def brute_targets(sizes, weights, cap):
    """Share by weight again and again until no source is above its cap."""
    rest, left, target = sum(sizes.values()), dict(sizes), {}
    while left:
        total = sum(weights[s] for s in left)
        above = [s for s in left if rest * weights[s] / total > cap * sizes[s]]
        if not above:
            return {**target, **{s: rest * weights[s] / total for s in left}}
        for s in above:
            target[s] = cap * sizes[s]
            rest -= target[s]
            del left[s]
    return target


def test_targets_share_the_excess_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 40, "d": 3, "e": 700, "f": 0, None: 250}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    weighted = mixing.cycle_weights(df)
    weights = {r.source: r.weight for r in weighted.collect()}
    assert [weights[s] for s in ("a", "b", "c", "d", "e", "f", None)] == [5, 2, 1, 5, 2, 1, 5]
    got = {r.source: r.target for r in mixing.targets(weighted).collect()}
    assert got == pytest.approx(brute_targets(sizes, weights, 3))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_come_near_the_targets(documents, prose):
    texts = [prose(i, 20 + i % 30) for i in range(3000)]
    planned = mixing.mix_plan(documents(texts)).withColumn(
        "taken", F.col("mix_size") * F.col("mix_copies")
    )
    rows = planned.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("mix_target").alias("target")
    ).collect()
    assert len(rows) == 3
    for r in rows:
        assert r.taken == pytest.approx(r.target, rel=0.05)
    assert planned.where("mix_copies > 3 or mix_copies < 0").count() == 0
    assert sorted(planned.collect()) == sorted(planned.collect())


def test_documents_are_repeated_as_planned(documents, prose):
    docs = documents([prose(i, 10 + i) for i in range(60)] + [None, ""])
    plan = {r.doc_id: r.mix_copies for r in mixing.mix_plan(docs).collect()}
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {k: n for k, n in plan.items() if n}


def test_nulls_repeats_empty_and_clashing(documents):
    docs = documents(["a b", "a b", None, "", "c d e"], [None, 1, None, 2, 1])
    planned = mixing.mix_plan(docs)
    assert planned.count() == 5
    assert sorted(r.mix_size for r in planned.collect()) == [0, 0, 2, 2, 3]
    assert mixing.mix_plan(docs.limit(0)).collect() == []
    odd = docs.select("*", F.lit(1).alias("mix_copies"), F.lit(2).alias("__source"))
    assert mixing.mix_sources(odd).columns == odd.columns
    mixing.mix_sources(odd).collect()
    silent = mixing.mix_plan(documents([None, "", " "]))
    assert [r.mix_copies for r in silent.collect()] == [0, 0, 0]
