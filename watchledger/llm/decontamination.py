"""Benchmark decontamination: which items' text stands inside which documents.

An item is contained in a document if at least ``threshold`` of the item's
distinct shingles occur in the document. Documents are far longer than items,
so the sketches of both cannot be compared like near-equal sets. Instead each
item is sketched by the smallest hashes of its own shingles, and the sketch is
looked up in all shingles of a document. The length of the sketch follows from
the size of the item: a document that holds ``ceil(threshold * n)`` of ``n``
shingles misses at most ``n - ceil(threshold * n)``, so of that many and one
more it holds at least one. No contained item is missed.

Items are partitioned by size: by the words of a shingle, which is the whole of an
item that has fewer words than a shingle, and by the number of shingles (powers of
two). A document's shingles of each length meet the partitions of that length, and
a partition also says how many shingles a document needs at least, which spares
short documents the lookup of long items.

Documents are read once. The same lookup that finds a sketch's hashes also counts
the item's other shingles, by their text and not by hashes, so a candidate is
verified without its text being moved: what is shuffled are the shingles that
occur in some item. Copies of a document are looked up once each and counted as
one.

Words are runs of letters and digits in lower case, so changes of case,
punctuation and white space do not hide a passage. In scripts without blanks a
clause counts as one word.

Defined cases: a document with fewer words than an item holds none of it. An item
or document without words, or null, matches nothing. Rows that repeat are judged
alike, and each copy of a contaminated document is removed. Items that repeat are
told apart by their ids; an item without an id still counts. Only ids and texts
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import KeyFilter, free_name, let, scratch_for
from watchledger.scratch import Scratch

SHINGLE = 5
THRESHOLD = 0.8
_WORDS = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Letters and digits in lower case, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(_WORDS), F.lit(0))


def shingles(found: Column, size: int | Column = SHINGLE) -> Column:
    """The runs of ``size`` words of an array, repeats included; none if it has fewer."""

    def cut(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(w) - size + 1)
        whole = F.transform(places, lambda i: F.array_join(F.slice(w, i, size), " "))
        return F.when(F.size(w) >= size, whole).otherwise(F.array().cast("array<string>"))

    return let(found, cut)


def text_key(text: Column) -> Column:
    """The SHA-256 of a text, as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def sketch_items(
    items: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
) -> DataFrame:
    """(item_id, parts, n, words, size_class, needed, sketch) for items with words.

    ``parts`` are the distinct shingles, ``words`` how many words each has,
    ``needed`` how many of them a document must hold, ``sketch`` the smallest hashes
    among them.
    """
    found = words(F.coalesce("text", F.lit("")))
    worded = items.select(F.col("item_id"), found.alias("found")).where("size(found) > 0")
    length = F.least(F.size("found"), F.lit(shingle))
    rows = worded.select(
        "item_id",
        length.alias("words"),
        F.array_distinct(shingles(F.col("found"), length)).alias("parts"),
    )
    n = F.size("parts")
    # Spared from rounding: 0.8 * 5 is a whole number and needs 4, not 5.
    needed = F.greatest(F.ceil(n * threshold - 1e-9), F.lit(1)).cast("int")
    hashes = F.array_sort(F.transform("parts", lambda p: F.xxhash64(p)))
    return rows.select(
        "item_id",
        "parts",
        n.alias("n"),
        "words",
        F.floor(F.log2(n.cast("double"))).cast("int").alias("size_class"),
        needed.alias("needed"),
        F.slice(hashes, F.lit(1), n - needed + 1).alias("sketch"),
    )


def probes(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, words, held, part) for the distinct shingles of each text, by length.

    ``key`` stands for the text, ``held`` is how many there are of that length.
    """
    found = words(F.col("text"))
    by_length = [
        F.struct(
            F.lit(length).alias("words"),
            F.array_distinct(shingles(found, length)).alias("parts"),
        )
        for length in lengths
    ]
    cut = docs.select(
        text_key(F.col("text")).alias("key"), F.explode(F.array(*by_length)).alias("cut")
    )
    return cut.select(
        "key",
        "cut.words",
        F.size("cut.parts").alias("held"),
        F.explode("cut.parts").alias("part"),
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(key, item_id, n_shingles, n_found, containment) per text and item.

    ``key`` is ``text_key`` of the document's text. The result is stored. The items'
    shingles are stored, so that Spark knows their size and sends them to all tasks
    only while that is small; beyond, they meet the documents' shingles by hash.
    """
    scratch = scratch_for(docs.sparkSession, scratch)
    # Items are told apart by their shingles; equal ones share one search.
    sketched = sketch_items(items, threshold, shingle).select(
        F.sha2(F.to_json("parts"), 256).alias("item_no"), "*"
    )
    known = scratch.stage(sketched, "items")
    unique = known.dropDuplicates(["item_no"])
    classes = ["words", "size_class"]
    least = unique.groupBy(*classes).agg(F.min("needed").alias("class_needed"))
    listed = unique.join(least, classes).select(
        "item_no", "words", "n", "needed", "class_needed", "sketch", F.explode("parts").alias("part")
    )
    entries = scratch.stage(
        listed.select(
            "item_no",
            "words",
            "part",
            F.xxhash64("part").alias("hash"),
            "n",
            "needed",
            "class_needed",
            F.array_contains("sketch", F.xxhash64("part")).alias("sketched"),
        ),
        "item-shingles",
    )
    # Five at most.
    lengths = sorted(r.words for r in entries.select("words").distinct().collect())
    if not lengths:
        return _contained(known.where("false").select(F.lit(b"").alias("key"), "*", F.lit(0).alias("n_found")), scratch)
    looked_up = probes(docs, lengths).withColumn("hash", F.xxhash64("part")).alias("d")
    met = looked_up.join(
        entries.alias("i"),
        (F.col("d.hash") == F.col("i.hash"))
        & (F.col("d.words") == F.col("i.words"))
        & (F.col("d.held") >= F.col("i.class_needed"))
        & (F.col("d.part") == F.col("i.part")),
    )
    # A text that is there several times brings each shingle as often.
    once = met.groupBy("key", "item_no", F.col("d.hash").alias("hash"), F.col("d.part").alias("part")).agg(
        F.max("sketched").alias("sketched"), F.max("needed").alias("needed"), F.max("i.n").alias("n")
    )
    checked = once.groupBy("key", "item_no", "n", "needed").agg(
        F.count(F.lit(1)).alias("n_found"), F.max("sketched").alias("sketched")
    )
    # A candidate holds a hash of the sketch.
    passed = checked.where("sketched and n_found >= needed")
    return _contained(passed.join(known.select("item_no", "item_id"), "item_no"), scratch)


def _contained(found: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.stage(
        found.select(
            "key",
            "item_id",
            F.col("n").cast("long").alias("n_shingles"),
            F.col("n_found").cast("long").alias("n_found"),
            (F.col("n_found") / F.col("n")).alias("containment"),
        ),
        "contained",
    )


def contaminated_documents(
    docs: DataFrame, items: DataFrame, scratch: Scratch | None = None, **options
) -> DataFrame:
    """One row per document and item that it contains, with the document's id."""
    found = contained_items(docs, items, scratch=scratch, **options)
    ids = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return ids.join(found, "key").drop("key")


def decontaminate(
    docs: DataFrame, items: DataFrame, scratch: Scratch | None = None, **options
) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    scratch = scratch_for(docs.sparkSession, scratch)
    found = contained_items(docs, items, scratch=scratch, **options)
    name = free_name(docs.columns, "text_key")
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(text_key(F.col("text")), F.lit(b"")).alias(name),
    )
    bad = scratch.stage(found.select(F.col("key").alias(name)).distinct(), "leaked-keys")
    maybe = free_name(keyed.columns, "maybe_leaked")
    marked = KeyFilter(bad, name, scratch).mark(keyed, name, maybe)
    # Few texts but leaked ones meet the keys; the others stay where they are.
    clean = marked.where(~F.col(maybe))
    checked = marked.where(F.col(maybe)).join(bad, name, "left_anti")
    return clean.unionByName(checked).drop(name, maybe)
