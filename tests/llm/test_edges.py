"""Every query with SQL, on a small table of edge cases."""

import duckdb
import pytest
from test_corpus_queries import ordered

from watchledger.llm import queries

KEY = "x9Kq2LmZ8vTr4WnB7cYd"
HEX = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
ITEM = "the quick brown fox jumps over the lazy dog near the old mill"
TEXTS = [
    None, "", " ", "\t\n", "one", "one two", "One, TWO", "a  b", "a b", "A B", f"token={KEY}", f"X-{HEX}",
    f"sig={HEX} /{HEX[:20]}", "password: 'hunter2hunter2'", ITEM, f"x {ITEM.upper()}! y", "word " * 3000,
    "#" + "uniq " * 3, " ".join(f"w{i}" for i in range(150)), "ÉÀ é 😀 " * 40, "one two three four five six",
]
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, extra string, spans int, size int, key int",
    "benchmark": "item_id long, text string, hash long, n int",
    "conversations": "conv_id long, turn long, role string, text string, made int, prompt string",
    "embeddings": "vec_id long, embedding array<float>, score int, rank int",
    "pages": "page_id long, url string, html string, payload string, digest int",
    "labels": "doc_id long, quality int, toxic int, n int",
}
NAN, INF = float("nan"), float("inf")


def made_rows():
    documents = [(i, t, [None, "en", "", "de"][i % 4], [None, "a", "b"][i % 3], None, "x", 1, 2, 3) for i, t in enumerate(TEXTS)]
    documents += [(None, t, "en", "a", 0, None, None, None, None) for t in (None, "one two", ITEM)]
    documents += documents[3:9] + [(2, ITEM, "en", "c", 5, "x", 1, 2, 3)]
    conversations = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (1, None, "system", "Be."), (1, 1, "assistant", "Yes!"),
        (2, None, None, None), (2, None, "user", "x"), (2, 3, "assistant", ""), (3, 0, "", " "), (3, 0, "tool", "t"),
        (None, 0, "user", "Hi."), (None, None, "assistant", None), (4, 9, "user", "long " * 5000), (5, 0, "Admin", "a.b"),
    ]
    conversations += [(c, t, ["user", "assistant"][t % 2], f"Turn {t % 3}.") for c in range(6, 40) for t in range(c % 7)]
    return {
        "documents": documents,
        "benchmark": [(i, t, 1, 2) for i, t in enumerate([ITEM, None, "", "one two", "w7", ITEM, "a b c d"])]
        + [(None, ITEM, 1, 2), (None, "one", 1, 2), (3, "quick brown fox jumps over", 1, 2)],
        "conversations": [(*r, 1, "p") for r in conversations],
        "embeddings": [(i, [i * 0.5, -1.0, i % 3 * 1.0][: 1 + i % 3], 1, 2) for i in range(45)]
        + [(50, None, 1, 2), (60, [None, 1.0], 1, 2), (80, [NAN], 1, 2), (100, [INF, 1.0], 1, 2), (120, [], 1, 2),
           (None, [1.0], 1, 2), (20, [10.0, -1.0, 2.0], 1, 2)],
        "pages": [(i, None, t, None, 0) for i, t in enumerate(TEXTS)] + [(None, "u", "one", "", 1), (None, "u", "n", "", 1)],
        "labels": [(i, [0, 1, None][i % 3], [1, None, 0][i % 3], 1) for i in range(0, 20, 2)] + [(2, 1, 1, 1), (None, 1, 1, 1)],
    }


@pytest.fixture(scope="module", params=["edges", "empty"])
def folder(spark, request, tmp_path_factory):
    base = tmp_path_factory.mktemp(request.param)
    for name, rows in made_rows().items():
        kept = rows if request.param == "edges" else []
        df = spark.createDataFrame(kept, SCHEMAS[name])
        df.coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return str(base)


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_its_sql_on_edge_cases(spark, folder, key):
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    df = queries.QUERIES[key](spark, folder)
    found = con.execute(queries.ORACLE[key])
    names = [column[0] for column in found.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.collect(), df.columns) == ordered(found.fetchall(), names)


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_queries_without_sql_give_every_row_a_result(spark, folder, key):
    rows = queries.QUERIES[key](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
