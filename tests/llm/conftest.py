import hashlib

import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def duck():
    """DuckDB with the tables of the smallest folder as views."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


@pytest.fixture
def documents(spark):
    """Documents from texts; ids, source and length follow from their place."""

    def make(texts, ids=None):
        rows = [
            (
                i if ids is None else ids[i],
                text,
                "en",
                None if i % 3 == 2 else f"s{i % 3}",
                None if text is None else len(text),
            )
            for i, text in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCUMENT)

    return make


@pytest.fixture
def prose():
    """Words that look random but are the same each time."""

    def make(seed, count):
        digest = "".join(
            hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i in range(count // 8 + 1)
        )
        letters = digest.translate(str.maketrans("0123456789", "ghijklmnop"))
        return " ".join(letters[8 * i : 8 * i + 5] for i in range(count))

    return make
