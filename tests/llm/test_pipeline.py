"""The pipeline: each stage by itself, and the whole against brute force."""

import re
from collections import Counter

import pytest
import test_decontamination
import test_secret_scan
import test_simhash
from pyspark.sql import functions as F

import corpus_pipeline
from watchledger.llm import quality, secret_scan

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage made of the smallest folder's documents."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        made.append(docs)
    return made


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier",
        "simhash_near_dedup",
        "benchmark_decontamination",
        "secret_scan",
        "mix_sources",
    ]


def test_stages_keep_the_columns_of_documents(stages):
    for made in stages[1:]:
        assert made.dtypes == stages[0].dtypes


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def test_each_stage_matches_brute_force(spark, stages):
    docs, good, single, clean, hidden, mixed = map(rows, stages)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.train(stages[0], labels)
    keep = {d for d, t, _ in docs if model.score(quality.features(t.encode())) >= 0.7}
    assert sorted(good) == sorted(r for r in docs if r[0] in keep)
    assert 0 < len(good) < len(docs)

    first = {c for *_, c in test_simhash.brute_components([(d, t) for d, t, _ in good])}
    assert sorted(single) == sorted(r for r in good if r[0] in first)
    assert len(single) < len(good)

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {d for d, *_ in test_decontamination.brute([(d, t) for d, t, _ in single], items)}
    assert sorted(clean) == sorted(r for r in single if r[0] not in leaks)
    assert leaks

    before = {d: t for d, t, _ in clean}
    assert sorted(before) == sorted(d for d, *_ in hidden)
    changed = 0
    for d, text, _ in hidden:
        spans = test_secret_scan.base_spans(before[d]) + test_secret_scan.entropy_spans(before[d])
        assert (text == before[d]) == (not spans)
        assert not test_secret_scan.base_spans(text)
        changed += bool(spans)
    assert changed

    known = {d: (t, s) for d, t, s in hidden}
    copies = Counter(d for d, *_ in mixed)
    assert all(known[d] == (t, s) for d, t, s in mixed) and max(copies.values()) <= 3
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    taken, size = sum(words(t) for _, t, _ in mixed), sum(words(t) for t, _ in known.values())
    assert taken == pytest.approx(size, rel=0.35)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(rows(corpus_pipeline.run(spark, FOLDER))) == sorted(rows(stages[-1]))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_nulls_repeats_and_no_rows(spark, documents, prose):
    docs = documents([None, "", "a b", prose("x", 40), prose("x", 40), f"token={'Ab1' * 8}"])
    docs = docs.withColumn("lang", F.lit(None).cast("string"))
    for data in (docs, docs.union(docs), docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, data, FOLDER).columns == docs.columns
            stage(spark, data, FOLDER).collect()
    hidden = corpus_pipeline.hide_secrets(spark, docs, FOLDER).collect()
    assert [r.text for r in hidden if r.doc_id == 5] == [secret_scan.PLACEHOLDER]
