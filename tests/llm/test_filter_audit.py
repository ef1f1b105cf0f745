"""The filter audit against running every order of the filters."""

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from watchledger.llm import filter_audit, queries

DOCS = "doc_id long, lang string, text string"
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """All rows of the audit, by applying the filters one after the other."""
    first = {}
    for doc_id, _, text in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}

    def failed(doc_id, text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        return {x for x, bad in fails.items() if bad}

    parts = {}
    for doc_id, part, text in docs:
        parts.setdefault(part or "", []).append((doc_id, failed(doc_id, text)))
    rows, totals = [], Counter()
    for part, members in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if letter in m[1]]
                left = [m for m in left if letter not in m[1]]
                fails = sum(letter in f for _, f in members)
                totals[part, letter] += len(gone)
                rows.append((
                    part, "".join(order), step, len(left), len(gone), fails - len(gone),
                    sum(f == {letter} for _, f in members),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), letter,
                ))
    return sorted((*r[:9], totals[r[0], r[9]]) for r in rows)


@pytest.fixture
def asked(spark, tmp_path):
    def run(docs, labels, docs_schema=DOCS, labels_schema=LABELS):
        spark.createDataFrame(docs, docs_schema).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(labels, labels_schema).write.parquet(str(tmp_path / "labels.parquet"))
        return sorted(map(tuple, queries.op12_filter_audit(spark, str(tmp_path)).collect()))

    return run


def made_texts(prose):
    return [
        prose("a", 150), prose("b", 40), "the cat " * 90, prose("c", 120).upper(), "#" + prose("d", 130),
        None, "", "  \t", "ONE $", prose("e", 150) + " é|", " " * 120, "X" * 200_000,
    ]


def test_matches_running_all_orders(prose, asked):
    texts = made_texts(prose)
    docs = [(i, ["en", "de", None, ""][i % 4], texts[i * 5 % len(texts)]) for i in range(60)]
    docs += [(None, "en", texts[0]), (None, "en", "rare"), (None, None, None), (3, "en", docs[3][2])]
    docs += [(3, "en", docs[3][2]), (0, "fr", docs[0][2])]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 60, 3)]
    labels += [(3, 0, None), (6, None, None), (6, 1, 1), (None, 1, 1), (99, 1, 1)]
    assert asked(docs, labels) == brute(docs, labels)


def test_every_part_has_all_orders_and_zeros(asked, prose):
    rows = asked([(1, "en", prose("clean", 150))], [])
    assert len(rows) == 600
    assert {r[3:] for r in rows} == {(1, 0, 0, 0, 0, 0, 0)}


def test_empty_tables(asked):
    assert asked([], []) == []


def test_a_third_of_the_rows_are_one_text(asked, prose):
    docs = [(i, "en" if i % 2 else "de", "same" if i % 3 == 0 else f"{i} {prose(i, 3)}") for i in range(900)]
    labels = [(i, 1, i % 2) for i in range(0, 900, 6)]
    assert asked(docs, labels) == brute(docs, labels)


def test_clashing_columns(spark, asked, prose):
    schema = DOCS + ", id long, part string, digest string, failed int, n int, key string, quality int"
    texts = made_texts(prose)
    docs = [(i, "en", t, 1, "x", "y", 3, 4, "z", 0) for i, t in enumerate(texts)]
    labels = [(1, 1, 0, 5, "q")]
    found = asked(docs, labels, schema, LABELS + ", n int, text string")
    assert found == brute([d[:3] for d in docs], [x[:3] for x in labels])


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6])
def test_potentials_give_the_values_over_all_orders(spark, n):
    """Any number of filters: totals of the orders, and potentials, agree."""
    letters = "ABCDEF"[:n]
    sets = [("p", s, (7 * s + 3) % 11) for s in range(1 << n)]
    tallied = spark.createDataFrame(sets, "part string, failed int, documents long")
    rows = filter_audit.audit(tallied, letters).withColumn(
        "letter", F.expr("substr(filter_order, step, 1)")
    )
    sums = rows.groupBy("letter").agg(F.sum("removed").alias("r"), F.max("shapley").alias("s"), F.min("shapley").alias("t"))
    for row in sums.collect():
        assert row.r == row.s == row.t
    last = rows.where(F.col("step") == n).select("kept").distinct().collect()
    assert [r.kept for r in last] == [sets[0][2]]
