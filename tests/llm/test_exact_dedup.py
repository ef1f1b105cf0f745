"""Exact deduplication against plain Python, and the index over several loads."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from watchledger.llm import exact_dedup, queries
from watchledger.llm.exact_dedup import DigestIndex

TEXTS = ["a b", "a\t\n b", " a b", None, "", "x", "a b", "é  é", "é é", "A b", "  ", " "]


def normalized(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    """(doc_id, keep_id, group_size, kept, digest) of (doc_id, text) rows."""
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(normalized(text), []).append((doc_id is None, doc_id, i))
    found = []
    for text, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2]))
        digest = hashlib.sha256(text.encode()).hexdigest()
        for place, (_, doc_id, _) in enumerate(members):
            found.append((doc_id, members[0][1], len(members), place == 0, digest))
    return sorted(found, key=repr)


def written(spark, tmp_path, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def asked(spark, folder):
    return sorted(map(tuple, queries.op11_exact_dedup(spark, folder).collect()), key=repr)


def test_query_matches_brute_force(spark, tmp_path):
    rows = [(97 * i % 13, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (None, "n"), (None, "n")]
    rows += [(3, "x"), (3, "x"), (2, "y" * 300_000), (1, "y" * 300_000)]
    assert asked(spark, written(spark, tmp_path, rows)) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert asked(spark, written(spark, tmp_path, [])) == []


def test_a_third_of_the_rows_are_copies(spark, tmp_path):
    rows = [(i, "same" if i % 3 == 0 else f"text {i // 2}") for i in range(6000)]
    assert asked(spark, written(spark, tmp_path, rows)) == brute(rows)


def test_salts_split_a_large_group(spark, scratch, documents):
    rows = exact_dedup.digested(documents(["same"] * 5000), scratch)
    counts = [r["count"] for r in rows.groupBy("digest", "salt").count().collect()]
    assert len(counts) == exact_dedup.LEAST_SALTS and max(counts) < 200


def test_three_loads_and_reopening(spark, documents, scratch, tmp_path):
    folder = str(tmp_path / "index")
    index = DigestIndex(spark, folder, 4)
    first = exact_dedup.take_in(documents(["a b", "c", "a  b"]), index, "1", scratch=scratch)
    assert sorted(r.text for r in first.collect()) == ["a b", "c"]
    second = exact_dedup.take_in(documents(["d", "c"], [8, 0]), index, "2", scratch=scratch)
    assert [(r.doc_id, r.text) for r in second.collect()] == [(8, "d")]
    spark.sql(f"drop table {index.table}")  # as a new session has none
    again = DigestIndex(spark, folder)
    assert again.buckets == 4 and again.loads() == ["1", "2"]
    third = exact_dedup.take_in(documents(["d", "e", "c"]), again, "3", scratch=scratch)
    assert [r.text for r in third.collect()] == ["e"]
    assert again.read().count() == 4


def test_a_load_that_failed_is_not_seen_and_can_be_repeated(spark, documents, scratch, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "index"), 4)
    rows = exact_dedup.digested(documents(["a", "b"]), scratch)
    index.add(rows, "1")
    (tmp_path / "index" / "_loaded" / "1").unlink()
    assert index.read().count() == 0
    index.add(rows, "1")
    index.add(rows, "1")
    assert index.loads() == ["1"] and index.read().count() == 2


def test_compacting_keeps_the_rows(spark, documents, scratch, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "index"), 4)
    for load, texts in enumerate((["a", "b"], ["b", "c"], ["d"])):
        index.add(exact_dedup.digested(documents(texts), scratch), str(load))
    before = sorted((r.digest, r.keep_id, r.keep_row) for r in index.read().collect())
    index.compact()
    assert sorted((r.digest, r.keep_id, r.keep_row) for r in index.read().collect()) == before
    assert len(index.loads()) == 1
    files = [f for f in (tmp_path / "index").rglob("*.parquet")]
    assert 0 < len(files) <= 4
    index.add(exact_dedup.digested(documents(["a", "z"]), scratch), "later")
    assert index.read().count() == 5


def test_the_index_is_neither_moved_nor_sorted(spark, documents, scratch, tmp_path, plan_of):
    index = DigestIndex(spark, str(tmp_path / "index"), 4)
    rows = exact_dedup.digested(documents(["a", "b", "a"]), scratch)
    index.add(rows, "1")
    with exact_dedup._sorted_scans(spark):
        firsts = index._per_salt(rows).groupBy("digest").agg(F.min("first").alias("first"))
        known = index.read().select("digest").hint("merge")
        plan = plan_of(firsts.join(known, "digest", "left_anti"))
    side = plan[plan.index("LeftAnti") :]
    side = side[side.rindex("+- ", 0, side.index(index.table)) :] if index.table in side else side
    below = plan[plan.rindex("Project") :]
    assert "SortMergeJoin" in plan and "Bucketed: true" in below
    assert "Exchange" not in below and "Sort " not in below


def test_new_documents_keep_clashing_columns(spark, scratch, tmp_path):
    rows = [(1, "a", 5, "k", 9), (1, "a", 5, "k", 9), (None, "b", 6, "k", 9), (None, "b", 7, "k", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest long, kept string, row long")
    index = DigestIndex(spark, str(tmp_path / "index"), 2)
    new = exact_dedup.take_in(docs, index, "1", scratch=scratch)
    assert new.columns == docs.columns
    assert sorted(r.text for r in new.collect()) == ["a", "b"]


def test_ids_may_be_text(spark, scratch, tmp_path):
    docs = spark.createDataFrame([("q", "a"), ("b", "a")], "doc_id string, text string")
    index = DigestIndex(spark, str(tmp_path / "index"), 2, "string")
    new = exact_dedup.take_in(docs, index, "1", scratch=scratch)
    assert [r.doc_id for r in new.collect()] == ["b"]


def test_a_folder_without_an_index_needs_a_number_of_buckets(spark, tmp_path):
    with pytest.raises(ValueError, match="buckets"):
        DigestIndex(spark, str(tmp_path / "none"))
