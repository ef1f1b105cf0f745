"""SimHash near-duplicates against a brute-force version."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from watchledger.llm import queries, simhash

FOLDER = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(p, seed=42).intdigest() for p in parts]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b, one in enumerate(bits) if one)


def brute_components(rows, distance=4):
    """(doc_id, fingerprint, component) of (doc_id, text) rows."""
    prints = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= distance):
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (low.get(find(i)), doc_id) if x is not None]
        low[find(i)] = min(ids) if ids else None
    return sorted(
        ((d, f"{int(p):016x}", low[find(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))),
        key=repr,
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def near_copies(prose, count):
    """One text and copies that each have another word changed."""
    words = prose("base", 400).split()
    texts = [" ".join(words)]
    for i in range(count):
        changed = list(words)
        changed[(7 * i) % 400] = f"w{i}"
        texts.append(" ".join(changed))
    return texts


@pytest.mark.parametrize("bucket_rows", [8192, 4])
def test_components_match_brute_force(spark, documents, prose, bucket_rows):
    texts = near_copies(prose, 40) + [prose(f"other{i}", 50) for i in range(20)]
    texts += [None, "", " \t\n", "one", "One", "one two three", texts[3], "A b c d"]
    rows = list(enumerate(texts))
    got = simhash.near_duplicates(documents(texts), bucket_rows=bucket_rows)
    assert found(got) == brute_components(rows)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = queries.QUERIES["op8_simhash_components"](spark, FOLDER)
    assert found(got) == brute_components(rows)


def test_other_distances(spark, documents, prose):
    texts = near_copies(prose, 25)
    for distance in (0, 1, 3, 7):
        got = simhash.near_duplicates(documents(texts), max_distance=distance)
        assert found(got) == brute_components(list(enumerate(texts)), distance)


def test_long_text_and_chunks(monkeypatch, prose):
    text = prose("long", 3000)
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_CHUNK", 64)
    assert simhash.fingerprint(text.encode()) == whole
    assert whole % (1 << 64) == brute_fingerprint(text)


def test_negative_fingerprints_are_compared_by_bits():
    a = np.array([-1, 3], np.int64)
    b = np.array([-2, -5], np.int64)
    assert simhash._near(a, b, 4).tolist() == [True, False]


def test_runs_of_any_length_give_the_same_components():
    random = np.random.default_rng(0)
    base = random.integers(-(2**62), 2**62, 5)
    prints = np.array([b ^ (1 << int(i)) for b in base for i in random.integers(0, 62, 30)])
    keys = np.zeros(len(prints), np.int64)
    results = []
    for small in (2, 1000):
        a, b = simhash._linked_runs(keys, prints, 4, small)
        nodes, roots = simhash.forest(a, b)
        results.append(dict(zip(nodes.tolist(), roots.tolist())))
    assert results[0] == results[1]


def test_chains_reach_their_smallest_end(spark, scratch):
    edges = [(i + 1, i) for i in range(60)] + [(200, 100), (200, 150)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in simhash.components(df, scratch).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_one_of_each_group_stays(documents, prose):
    texts = near_copies(prose, 5) + [None, "", prose("x", 30), prose("x", 30)]
    ids = [5, 3, 9, 4, 8, 7, None, 2, None, 1]
    docs = documents(texts, ids)
    kept = simhash.deduplicate(docs.union(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    assert kept.columns == docs.columns


def test_groups_without_ids_keep_one_row_each(documents, prose):
    docs = documents([prose("a", 30), prose("a", 30), prose("b", 30)], [None, None, None])
    assert simhash.deduplicate(docs).count() == 2
    assert [r.component_id for r in simhash.near_duplicates(docs).collect()] == [None] * 3


def test_empty_table_and_clashing_columns(documents, prose):
    docs = documents([prose("a", 30), prose("b", 30)])
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    assert simhash.deduplicate(docs.limit(0)).collect() == []
    names = ("fingerprint", "component_id", "content_1", "root", "_text")
    odd = docs.select("*", *[F.lit("x").alias(n) for n in names])
    assert simhash.near_duplicates(odd).columns == ["doc_id", "fingerprint", "component_id"]
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns and kept.count() == 2
