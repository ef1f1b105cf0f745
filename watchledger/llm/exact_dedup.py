"""Exact deduplication against a persistent index of digests.

The index is one table, bucketed and sorted by digest, with one folder per load.
A load's digests are grouped, held against the index by a sort-merge anti-join
that moves the load's side only, and the ones that are new are appended. The
table outlives the session: its folder holds everything, and opening it again
registers it. A load counts once its marker is written, so one that failed half
way is not seen and can be repeated.

A group of copies may hold any share of the rows. Rows are first grouped by
digest and salt, so that no task gets a whole large group, and get the group's
result back by the same two keys. There is one plan for all sizes.

Defined cases: a null text counts as empty. Texts are equal if they are
identical after every run of blanks, tabs, line breaks and form feeds becomes one
blank. Of equal texts the row with the smallest id stays, null ids last; of rows
that repeat that id too, any one. A text that an earlier load brought keeps that
load's row. An empty table adds nothing. Only the id and text columns are
interpreted, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watchledger.llm.common import free_name, scratch_for
from watchledger.operators import keep_top
from watchledger.scratch import Scratch

BLANKS = r"[\x20\x09-\x0D]+"
#: Digests of one bucket, some 100 MB, and rows of one salted group.
BUCKET_ROWS = 2_000_000
SALTED_ROWS = 1_000_000
LEAST_BUCKETS, LEAST_SALTS = 8, 64
_LOADED, COMPACTED = "_loaded", "compacted-"
# Without it a scan does not say that a bucket's only file is sorted.
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalized text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalized(text).cast("binary"), 256))


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, math.ceil(rows / BUCKET_ROWS))


def digested(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns id, digest, row and salt, stored; ``row`` is unique.

    Texts are read here and not again. The salt deals the rows of one group.
    """
    rows = docs.select(
        F.col(id).alias("id"),
        digest(F.col(text)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    stored = scratch.stage(rows, "digests")
    salts = max(LEAST_SALTS, math.ceil(stored.count() / SALTED_ROWS))
    return stored.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))


class DigestIndex:
    """Digests seen so far, with the row that stays, in a folder of their own.

    ``buckets`` is fixed when the index is made; it is read from the folder
    afterwards. ``id_type`` is the type of the ids.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        buckets: int | None = None,
        id_type: str = "bigint",
    ):
        self.spark, self.folder = spark, folder.rstrip("/")
        made = self._names("buckets-*")
        if not made and buckets is None:
            raise ValueError(f"{folder} holds no index; say how many buckets it gets")
        self.buckets = int(made[0].rsplit("-", 1)[1]) if made else buckets
        self.path = f"{self.folder}/buckets-{self.buckets:05d}"
        self.table = f"digests_{hashlib.md5(self.path.encode()).hexdigest()}"
        spark.sql(
            f"create table if not exists {self.table}"
            f" (digest binary, keep_id {id_type}, keep_row bigint, load string)"
            " using parquet partitioned by (load)"
            f" clustered by (digest) sorted by (digest) into {self.buckets} buckets"
            f" location '{self.path}'"
        )
        path, files = self._path(self.path)
        files.mkdirs(path)
        spark.sql(f"msck repair table {self.table}")

    def loads(self) -> list[str]:
        """The complete loads, oldest first, from the last compacted one on."""
        path, files = self._path(f"{self.folder}/{_LOADED}/*")
        marks = sorted(
            (s.getModificationTime(), s.getPath().getName()) for s in files.globStatus(path) or []
        )
        names = [name for _, name in marks]
        whole = [i for i, name in enumerate(names) if name.startswith(COMPACTED)]
        return names[whole[-1] :] if whole else names

    def read(self, without: str | None = None) -> DataFrame:
        """Digests of the complete loads, each once."""
        wanted = [load for load in self.loads() if load != without]
        return self.spark.table(self.table).where(F.col("load").isin(wanted))

    def add(self, rows: DataFrame, load: str) -> None:
        """Append the digests of ``rows`` (see ``digested``) that are new.

        A load that is repeated replaces what it appended before.
        """
        firsts = self._per_salt(rows).groupBy("digest").agg(F.min("first").alias("first"))
        with _sorted_scans(self.spark):
            known = self.read(without=load).select("digest").hint("merge")
            fresh = firsts.join(known, "digest", "left_anti").select(
                "digest",
                F.col("first.id").alias("keep_id"),
                F.col("first.row").alias("keep_row"),
            )
            self._forget(load)
            self._append(fresh, load)

    def resolve(self, rows: DataFrame) -> DataFrame:
        """``rows`` with keep_id, keep_row, load and group_size, their number.

        The window is over the salted parts of a group, of which there are as
        many as salts.
        """
        whole = Window.partitionBy("digest")
        parts = self._per_salt(rows).select(
            "digest", "salt", F.sum("n").over(whole).alias("group_size")
        )
        with_index = parts.join(self.read().hint("merge"), "digest")
        return rows.join(with_index, ["digest", "salt"])

    def compact(self) -> None:
        """Rewrite all loads as one with a sorted file per bucket.

        Rows keep their digests and ids. No load may run meanwhile. Once the new
        files are complete they hide the old ones, which are then dropped.
        """
        old = self.loads()
        load = f"{COMPACTED}{uuid.uuid4().hex}"
        everything = self.read().select("digest", "keep_id", "keep_row")
        self._append(everything.repartition(self.buckets, "digest"), load)
        for name in old:
            self._forget(name)

    def _per_salt(self, rows: DataFrame) -> DataFrame:
        """First row and number of rows per digest and salt, dealt like the buckets."""
        first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row"))
        counted = rows.groupBy("digest", "salt").agg(
            first.alias("first"), F.count(F.lit(1)).alias("n")
        )
        return counted.repartition(self.buckets, "digest")

    # -- the folder ----------------------------------------------------------

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, pattern: str) -> list[str]:
        path, files = self._path(f"{self.folder}/{pattern}")
        return sorted(s.getPath().getName() for s in files.globStatus(path) or [])

    def _append(self, rows: DataFrame, load: str) -> None:
        """Write the rows as one load, then its marker."""
        view = f"{self.table}_new"
        rows.createOrReplaceTempView(view)
        self.spark.sql(
            f"insert into {self.table} partition (load = '{load}')"
            f" select digest, keep_id, keep_row from {view}"
        )
        self.spark.catalog.dropTempView(view)
        path, files = self._path(f"{self.folder}/{_LOADED}/{load}")
        files.create(path, True).close()

    def _forget(self, load: str) -> None:
        """Take away a load, complete or not."""
        for name in (f"{self.folder}/{_LOADED}/{load}", f"{self.path}/load={load}"):
            path, files = self._path(name)
            files.delete(path, True)
        self.spark.sql(f"alter table {self.table} drop if exists partition (load = '{load}')")


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_ORDERED, None)
    spark.conf.set(_ORDERED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ORDERED)
        else:
            spark.conf.set(_ORDERED, before)


def take_in(
    docs: DataFrame,
    index: DigestIndex,
    load: str,
    id: str = "doc_id",
    text: str = "text",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Add a load to the index and return its documents that are new, whole.

    One row per new text. Rows are reduced to one per text and id before they
    are shuffled, then meet the load's part of the index.
    """
    index.add(digested(docs, scratch_for(docs.sparkSession, scratch), id, text), load)
    key, kept = (free_name(docs.columns, name) for name in ("digest", "kept"))
    keyed = docs.withColumn(key, digest(F.col(text)))
    single = keep_top(keyed, [key, id], [F.asc_nulls_first(text)])
    new = index.read().where(F.col("load") == load).select(
        F.col("digest").alias(kept), F.col("keep_id").alias(f"{kept}_id")
    )
    same = (F.col(key) == F.col(kept)) & F.col(id).eqNullSafe(F.col(f"{kept}_id"))
    return single.join(new, same, "left_semi").drop(key)
