"""SimHash near-duplicate detection with deletion-variant signatures.

Two 64-bit fingerprints that differ in at most ``d`` bits are cut into
``d // 2 + 1`` segments. If every segment differed in two bits or more, the
fingerprints would differ in more than ``d``; so one segment differs in at most
one bit. Each segment is indexed once per bit with that bit left out: two
segments share such a variant exactly if they differ in at most that bit. Equal
variants meet in one sorted run, where the full distance is verified.

Runs hand on a spanning forest instead of all their pairs, which keeps every
link's effect on the components. Copies have one fingerprint and enter the
index once. Buckets that would hold more than ``bucket_rows`` fingerprints are
found beforehand from the counts of the plain segments and cut into blocks that
meet two at a time.

Defined cases: a null or empty text, or one of white space only, has
fingerprint zero and is linked like any other. A text with fewer words than a
shingle is one shingle. Rows that repeat are rows of their own with the same
component. A null id never names a component unless all its ids are null. Only
the id and text columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import free_name, scratch_for, ship_package
from watchledger.scratch import Scratch

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
BUCKET_ROWS = 8192
_CHUNK = 1 << 16


# -- fingerprints ------------------------------------------------------------


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of one text as a signed 64-bit number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        ends = ends[shingle - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, len(starts)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        bits = np.unpackbits(
            hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > total, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    docs: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    shingle: int = SHINGLE,
    seed: int = SEED,
) -> DataFrame:
    """The kept columns of each row and the fingerprint of its text."""
    ship_package(docs.sparkSession)
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    schema = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}"
        for field in rows.schema.fields[:-1]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            prints = [fingerprint(t.as_py(), shingle, seed) for t in texts]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(prints, pa.int64())], [*keep, "fingerprint"]
            )

    return rows.mapInArrow(run, f"{schema}, fingerprint long")


def as_hex(column: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


# -- links -------------------------------------------------------------------


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(offset, width) of the segments; one differs in at most one bit."""
    count = max_distance // 2 + 1
    edges = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _segment(column: Column, offset: int, width: int) -> Column:
    mask = _signed(((1 << width) - 1) << offset)
    return column.bitwiseAND(F.lit(mask).cast("long"))


def _variants(column: Column, offset: int, width: int) -> list[Column]:
    """A key for each bit of the segment, with that bit left out.

    Keys are hashed; a clash only adds a candidate that is then verified.
    """
    whole = ((1 << width) - 1) << offset
    keys = []
    for bit in range(offset, offset + width):
        mask = _signed(whole & ~(1 << bit))
        left = column.bitwiseAND(F.lit(mask).cast("long"))
        keys.append(F.xxhash64(F.lit(bit), left))
    return keys


def _crowded(
    prints: DataFrame, cuts: list[tuple[int, int]], rows: int, scratch: Scratch
) -> DataFrame:
    """Variants with too many fingerprints for one run, and their blocks."""
    fp = F.col("fingerprint")
    plain = prints.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("cut"), _segment(fp, *cut).alias("value"))
                    for i, cut in enumerate(cuts)
                ]
            )
        ).alias("s")
    )
    counted = (
        plain.groupBy("s.cut", "s.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > rows // 2)
    )
    keys = F.array()
    for i, cut in enumerate(cuts):
        own = F.array(*_variants(F.col("value"), *cut))
        keys = F.when(F.col("cut") == i, own).otherwise(keys)
    spread = counted.select("n", F.explode(keys).alias("variant"))
    # A variant joins two plain segments; the one that is not here has at most
    # half of ``rows``.
    blocks = F.ceil((F.sum("n") + rows // 2) / F.lit(rows)).cast("int")
    return scratch.stage(spread.groupBy("variant").agg(blocks.alias("blocks")), "crowded")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for every node that is not it."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if np.array_equal(label, before):
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _near(a: np.ndarray, b: np.ndarray, max_distance: int) -> np.ndarray:
    # Unsigned: of a negative number the bits of its absolute value would count.
    return np.bitwise_count((a ^ b).view(np.uint64)) <= max_distance


def spanning(prints: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what belongs together, each row compared once."""
    left = np.unique(prints)
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            one = front.pop()
            near = _near(left, one, max_distance)
            if near.any():
                found = left[near]
                left = left[~near]
                a.append(np.full(len(found), one))
                b.append(found)
                front.extend(found)
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _linked_runs(
    keys: np.ndarray, prints: np.ndarray, max_distance: int, small: int = 256
) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within runs of equal keys."""
    bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(bounds)
    a, b = [], []
    for i in np.flatnonzero(sizes > small):
        x, y = spanning(prints[bounds[i] : bounds[i + 1]], max_distance)
        a.append(x)
        b.append(y)
    few = np.repeat((sizes > 1) & (sizes <= small), sizes)
    k, p = keys[few], prints[few]
    step = 1
    while step < len(k):
        same = np.flatnonzero(k[step:] == k[:-step])
        if not len(same):
            break
        near = _near(p[same + step], p[same], max_distance)
        a.append(p[same[near]])
        b.append(p[same[near] + step])
        step += 1
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(a), np.concatenate(b))


def links(
    prints: DataFrame,
    max_distance: int = MAX_DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Links (a, b), a > b, with the components of all near fingerprints.

    ``prints`` has distinct fingerprints in a column of that name.
    """
    scratch = scratch_for(prints.sparkSession, scratch)
    ship_package(prints.sparkSession)
    cuts = segments(max_distance)
    fp = F.col("fingerprint")
    crowded = _crowded(prints, cuts, bucket_rows, scratch)
    variants = F.array(*[key for cut in cuts for key in _variants(fp, *cut)])
    indexed = prints.select("fingerprint", F.explode(variants).alias("variant"))
    marked = indexed.join(crowded, "variant", "left")
    own = F.pmod(F.xxhash64("fingerprint", F.lit(7)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    met = marked.select("fingerprint", "variant", "blocks", own.alias("own"), other.alias("other"))
    block = F.xxhash64("variant", F.least("own", "other"), F.greatest("own", "other"))
    routed = met.select(
        F.when(F.col("blocks").isNull(), F.col("variant")).otherwise(block).alias("route"),
        "fingerprint",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = prints_ = np.empty(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints_ = np.concatenate([prints_, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield linked(keys[:cut], prints_[:cut])
            keys, prints_ = keys[cut:], prints_[cut:]
        if len(keys):
            yield linked(keys, prints_)

    def linked(keys: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        a, b = _linked_runs(keys, found, max_distance)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )

    runs = routed.repartition("route").sortWithinPartitions("route")
    return runs.mapInArrow(run, "a long, b long").distinct()


# -- components --------------------------------------------------------------


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of a link; the root is the smallest node.

    Alternates the large-star and small-star steps until nothing changes. Each
    step is a map-side combined minimum and an equality join; rows never exceed
    the links. Every round is a stored table, so a lost executor repeats no
    earlier round.
    """
    stars = scratch.stage(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = stars.select("a", "b").union(stars.select(F.col("b"), F.col("a")))
        lowest = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
        large = (
            both.join(lowest, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        large = scratch.stage(large, "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(lowest, "a")
        small = (
            moved.select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(moved.select("a", F.col("low").alias("b")))
            .where("a != b")
            .distinct()
        )
        stars = scratch.stage(small, "small-star")
        state = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def component_of_fingerprint(
    prints: DataFrame,
    id_column: str = "doc_id",
    max_distance: int = MAX_DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(fingerprint, root, component_id) for every fingerprint.

    The root is the smallest fingerprint it reaches, the component the smallest
    id of all documents that have one of these fingerprints.
    """
    scratch = scratch_for(prints.sparkSession, scratch)
    groups = scratch.stage(
        prints.groupBy("fingerprint").agg(F.min(id_column).alias("low")), "fingerprints"
    )
    edges = links(groups.select("fingerprint"), max_distance, bucket_rows, scratch)
    roots = components(edges, scratch).withColumnRenamed("node", "fingerprint")
    linked = scratch.stage(groups.join(roots, "fingerprint"), "linked")
    lowest = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    joined = linked.join(lowest, "root").select("fingerprint", "root", "component_id")
    own = F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("component_id"))
    whole = groups.join(joined, "fingerprint", "left").select(
        "fingerprint",
        F.coalesce("root", "fingerprint").alias("root"),
        own.alias("component_id"),
    )
    return scratch.stage(whole, "components")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    max_distance: int = MAX_DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (hexadecimal), component_id."""
    scratch = scratch_for(docs.sparkSession, scratch)
    prints = scratch.stage(
        fingerprints(docs, shingle=shingle, seed=seed), "prints"
    )
    found = component_of_fingerprint(
        prints, "doc_id", max_distance, bucket_rows, scratch
    )
    return prints.join(found.drop("root"), "fingerprint").select(
        "doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def deduplicate(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    max_distance: int = MAX_DISTANCE,
    bucket_rows: int = BUCKET_ROWS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One document of each component, with all its columns.

    The smallest id stays, null last; among rows with the same id the one whose
    content has the smallest hash, and a row that is there several times stays
    once. Only hashes and fingerprints are compared; the texts meet the list of
    what stays in one join.
    """
    scratch = scratch_for(docs.sparkSession, scratch)
    names = [F.col(f"`{c}`") for c in docs.columns]
    keys = [free_name(docs.columns, k) for k in ("content_1", "content_2")]
    keyed = docs.select(
        *names,
        F.xxhash64(*names).alias(keys[0]),
        F.xxhash64(F.lit(SEED), *names).alias(keys[1]),
    )
    prints = scratch.stage(
        fingerprints(keyed, keep=("doc_id", *keys), shingle=shingle, seed=seed), "prints"
    )
    found = component_of_fingerprint(prints, "doc_id", max_distance, bucket_rows, scratch)
    # Ids may be null, so a component is told by its root here.
    rows = prints.join(found.select("fingerprint", "root"), "fingerprint")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *keys)
    first = rows.groupBy("root").agg(F.min(order).alias("first"))
    copies = prints.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    chosen = first.select(*[f"first.{k}" for k in keys]).join(copies, keys)
    stay = scratch.stage(chosen, "stay")
    once = keyed.join(stay.where("copies = 1"), keys, "left_semi")
    several = keyed.join(stay.where("copies > 1"), keys, "left_semi").dropDuplicates(keys)
    return once.union(several).select(*names)
