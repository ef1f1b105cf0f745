"""Decontamination: containment against brute force, and what removal keeps."""

import re

from pyspark.sql import functions as F

from watchledger.llm import decontamination


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def parts(text, size):
    words = words_of(text)
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(docs, items, threshold=0.8):
    found = set()
    for i, item in items:
        size = min(len(words_of(item)), 5)
        need = parts(item, size) if size else set()
        for d, text in docs:
            have = parts(text, size) if size else set()
            if need and len(need & have) >= threshold * len(need) - 1e-9:
                found.add((d, i, len(need), len(need & have)))
    return found


def items_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def cases(prose):
    items = [prose(f"item{i}", 6 + 5 * i) for i in range(10)] + [None, "", "one two", "A b, c"]
    docs = []
    for i, item in enumerate(items[:10]):
        words = item.split()
        around = prose(f"left{i}", 300), prose(f"right{i}", 2000)
        docs.append(f"{around[0]} {item} {around[1]}")
        docs.append(f"{around[0]} {item.upper().replace(' ', ' - ')}! {around[1]}")
        # A changed word takes five shingles away, and the end of a long item
        # leaves more than four fifths.
        docs.append(" ".join([around[0], *words[: len(words) // 2], "x", *words[len(words) // 2 :]]))
        docs.append(" ".join([around[0], *words[: round(0.9 * len(words))], around[1]]))
        docs.append(" ".join([around[0], *words[: len(words) // 2], around[1]]))
    return items, docs + [None, "", "one two", "ONE, two", "one two three", "a b c", prose("clean", 900)]


def test_containment_matches_brute_force(spark, documents, prose):
    items, texts = cases(prose)
    docs = documents(texts)
    got = decontamination.contaminated_documents(docs, items_of(spark, items))
    rows = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()}
    assert rows == brute(list(enumerate(texts)), list(enumerate(items)))
    assert len(rows) > 25


def test_clean_documents_stay_with_all_columns(spark, documents, prose):
    items, texts = cases(prose)
    docs = documents(texts)
    docs = docs.union(docs)
    bad = {d for d, *_ in brute(list(enumerate(texts)), list(enumerate(items)))}
    kept = decontamination.decontaminate(docs, items_of(spark, items))
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted(2 * [i for i in range(len(texts)) if i not in bad])


def test_repeated_items_and_null_ids(spark, documents, prose):
    text = prose("x", 20)
    items = spark.createDataFrame([(1, text), (2, text), (None, text)], "item_id long, text string")
    docs = documents([f"{prose('l', 50)} {text}", prose("y", 50)], [None, 4])
    got = decontamination.contaminated_documents(docs, items).collect()
    assert sorted(map(str, (r.item_id for r in got))) == ["1", "2", "None"]
    assert {r.doc_id for r in got} == {None}
    assert [r.doc_id for r in decontamination.decontaminate(docs, items).collect()] == [4]


def test_empty_tables_and_clashing_columns(spark, documents, prose):
    items = items_of(spark, [prose("x", 20)])
    docs = documents([prose("x", 20), prose("y", 20)])
    assert decontamination.decontaminate(docs.limit(0), items).collect() == []
    assert decontamination.decontaminate(docs, items.limit(0)).count() == 2
    odd = docs.select("*", *[F.lit("x").alias(n) for n in ("key", "text_key", "hash", "held")])
    kept = decontamination.decontaminate(odd, items)
    assert kept.columns == odd.columns and kept.count() == 1


def test_a_common_passage_is_counted_once_per_text(spark, documents, prose):
    items = items_of(spark, [prose("x", 30)])
    docs = documents([prose("x", 30)] * 500)
    assert decontamination.contained_items(docs, items).count() == 1
    assert decontamination.contaminated_documents(docs, items).count() == 500


def test_short_items_are_found_inside_long_documents(spark, documents, prose):
    items = ["zwei", "one two", "a b c", "w x y z", prose("long", 9)]
    around = prose("around", 3000)
    texts = [f"{around} {t.upper()}, {around}" for t in items]
    texts += [around, "one three two", "One - two", "c b a", "x y z", " ".join(items)]
    docs = documents(texts)
    got = decontamination.contaminated_documents(docs, items_of(spark, items))
    rows = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got.collect()}
    assert rows == brute(list(enumerate(texts)), list(enumerate(items)))
    assert {(i, i) for i in range(5)} <= {r[:2] for r in rows}


def test_texts_are_read_once_and_not_moved(spark, documents, prose, monkeypatch, plan_of):
    """What is stored and shuffled are ids, keys and shingles of items."""
    from watchledger.scratch import Scratch

    staged, stage = {}, Scratch.stage

    def watched(self, df, name):
        staged[name] = plan_of(df)
        return stage(self, df, name)

    monkeypatch.setattr(Scratch, "stage", watched)
    path = documents([prose("x", 40), prose("y", 40)])
    kept = decontamination.decontaminate(path, items_of(spark, [prose("x", 30)]))
    assert [r.doc_id for r in kept.collect()] == [1]
    scans = [p.count("Scan") for n, p in staged.items() if n == "contained"]
    assert len(scans) == 1 and "text" not in "".join(
        x for x in staged["contained"].splitlines() if "Exchange" in x
    )


def test_long_documents(spark, documents, prose):
    items = [prose(f"i{i}", 40) for i in range(50)]
    text = " ".join([prose("head", 100_000), items[7], prose("tail", 100_000), items[31]])
    got = decontamination.contaminated_documents(documents([text]), items_of(spark, items))
    assert sorted(r.item_id for r in got.collect()) == [7, 31]
