"""Token counts of whole texts with a public byte-pair tokenizer.

A token never crosses a pre-token, so a text has as many tokens as its
pre-tokens have together. The first tier is a compact table of the corpus's
frequent pre-tokens and their lengths, of at most ``TABLE_ROWS`` rows, sent to
all tasks. What it misses is encoded by the tokenizer library itself, in batches,
and kept in a cache of the worker process that outlives the task. No pre-token
of a text is shuffled: to find the frequent ones every task counts its own and
hands on at most ``TASK_ROWS`` of them.

The tables change speed alone. A length is what the library says for the
pre-token, and the table of frequent ones is encoded by the library too.

Pre-tokens are cut here by the tokenizer's own pattern, spelled out for the
characters in ``_PLAIN``, for which lower case and the classes of letters and
numbers are fixed and composing changes nothing. A stretch between white space with
any other character is looked up and cached as it stands, and encoded by the library
where it is not known; the rest of its text is cut as usual.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Special tokens
within a text count as one token, as the library reads them by default. Rows
that repeat count alike. An empty table gives an empty result. Only the named
columns are read, so further columns may have any name.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import ship_package

TABLE_ROWS = 1 << 16
TASK_ROWS = 1 << 13
COUNTER_ROWS = 1 << 18
CACHE_ROWS = 1 << 19
TABLE_CHARS = 64

#: Latin with its extensions, Cyrillic, punctuation, and unified ideographs.
_PLAIN = ((0x0000, 0x0250), (0x0400, 0x0482), (0x048A, 0x0530), (0x2010, 0x2028),
          (0x2030, 0x205F), (0x20AC, 0x20AD), (0x4E00, 0x9FA6))


def _ranges(codes: list[int]) -> str:
    """Sorted code points as the inside of a character class."""
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def _plain_class(category: str) -> str:
    """The plain characters in lower case of a general category, for a pattern."""
    lower = {ord(x) for a, b in _PLAIN for c in range(a, b) for x in chr(c).lower()}
    return _ranges([c for c in sorted(lower) if unicodedata.category(chr(c))[0] == category])


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """(a character that is not plain, white space, a pre-token of lower-cased text)."""
    plain = "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in _PLAIN)
    letter, number = _plain_class("L"), _plain_class("N")
    space = r"\x09-\x0d\x20\x85\xa0"
    # The alternatives of the tokenizer's pattern, in its order.
    token = (
        rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+"
    )
    return re.compile(f"[^{plain}]"), re.compile(f"[{space}]+"), re.compile(token)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer of a file, one per worker process."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _special(path: str) -> re.Pattern:
    added = tokenizer(path).get_added_tokens_decoder().values()
    names = sorted((t.content for t in added if t.special), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, names)) or r"(?!)")


def pretokens(text: str, path: str) -> tuple[int, list[str]]:
    """Special tokens of a text, and its pre-tokens.

    A stretch between white space that has a character outside ``_PLAIN`` is one of
    them as it stands: no pre-token reaches across white space.
    """
    odd, space, token = _patterns()
    stretches: list[str] = []
    if odd.search(text):
        plain = []
        for stretch in space.split(text):
            (stretches if odd.search(stretch) else plain).append(stretch)
        text = " ".join(plain)
    special = _special(path)
    if not special.search(text):
        return 0, token.findall(text.lower()) + stretches
    pieces = special.split(text)
    return len(pieces) - 1, [t for p in pieces for t in token.findall(p.lower())] + stretches


def lengths(texts: list[str], path: str) -> list[int]:
    """Tokens of each text, as the library gives them."""
    found = tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)
    return [len(e.ids) for e in found]


#: Lengths that a worker process has looked up, by tokenizer file.
_cache: dict[str, dict[str, int]] = {}


def count_tokens(texts: list[str | None], path: str, table: dict[str, int]) -> list[int]:
    """Tokens of each text through the table, the cache, and the library."""
    cache = _cache.setdefault(path, {})
    totals = [0] * len(texts)
    waiting: list[tuple[int, list[str]]] = []
    for i, text in enumerate(texts):
        if not text:
            continue
        totals[i], found = pretokens(text, path)
        known = list(map(table.get, found))
        if None in known:
            missing = [t for t, n in zip(found, known) if n is None]
            totals[i] += sum(n for n in known if n is not None)
            rest = list(map(cache.get, missing))
            if None in rest:
                waiting.append((i, missing))
                continue
            known = rest
        totals[i] += sum(known)
    unknown = list({t for _, missing in waiting for t in missing if t not in cache})
    fresh = dict(zip(unknown, lengths(unknown, path)))
    for i, missing in waiting:
        totals[i] += sum(fresh[t] if t in fresh else cache[t] for t in missing)
    if len(cache) + len(fresh) > CACHE_ROWS:
        cache.clear()
    cache.update((t, n) for t, n in fresh.items() if len(t) <= TABLE_CHARS)
    return totals


def frequent_lengths(docs: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """The corpus's frequent pre-tokens with their numbers of tokens."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(pretokens(text, path)[1])
                if len(counts) > COUNTER_ROWS:
                    counts = Counter(dict(counts.most_common(COUNTER_ROWS // 2)))
        short = ((t, n) for t, n in counts.items() if len(t) <= TABLE_CHARS)
        top = heapq.nlargest(TASK_ROWS, short, key=lambda x: (x[1], x[0]))
        yield pa.RecordBatch.from_pydict(
            {"token": pa.array([t for t, _ in top], pa.string()),
             "n": pa.array([n for _, n in top], pa.int64())}
        )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(0)
            found = lengths(tokens.to_pylist(), path)
            yield pa.RecordBatch.from_pydict(
                {"token": tokens, "length": pa.array(found, pa.int32())}
            )

    counted = docs.select(text).mapInArrow(count, "token string, n long")
    top = (
        counted.groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(TABLE_ROWS)
    )
    found = top.select("token").mapInArrow(encode, "token string, length int").toArrow()
    return dict(zip(found["token"].to_pylist(), found["length"].to_pylist()))


def token_counts(
    docs: DataFrame,
    path: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The kept columns of each row with n_bytes and n_tokens of its text.

    ``path`` is the tokenizer's file, at the same place on every executor.
    """
    spark = docs.sparkSession
    ship_package(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    names = [*keep, "n_bytes", "n_tokens"]
    kept = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
            counted = count_tokens(texts.to_pylist(), path, table.value)
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(sizes, pa.int64()), pa.array(counted, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, f"{kept}, n_bytes long, n_tokens long")
