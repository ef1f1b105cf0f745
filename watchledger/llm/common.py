"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchledger.scratch import Scratch

#: A word is a run of anything but blank, tab, line breaks and form feeds.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Rows set aside from training: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that follows from the seed and the parts alone."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def scratch_for(spark: SparkSession, scratch: Scratch | None) -> Scratch:
    """The given one, or one whose tables go when the application ends."""
    return scratch if scratch is not None else Scratch(spark).drop_at_exit()


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped[app] = folder = tempfile.TemporaryDirectory(prefix="watchledger-code-")
    package = Path(__file__).resolve().parents[1]
    archive = Path(folder.name) / "watchledger.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


#: Classifiers learn from about so many labelled rows, some 12 MB, at most.
LABEL_ROWS = 1 << 18
_SHARES = 1 << 30


def label_sample(stored: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """A stored table of training labels, or about ``rows`` of them by a hash of the id.

    The bound holds for the broadcast that takes the labels to the texts, so that
    no text is shuffled to its label, however many labels there are.
    """
    count = stored.count()
    share = _SHARES if count <= rows else _SHARES * rows // count
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(_SHARES)) < share
    return F.broadcast(stored.where(drawn))


#: Positions of a key filter and bits per bitmap; 2^26 positions are 8 MB.
FILTER_BITS = 26
_BITMAP = 1 << 15


class KeyFilter:
    """A bitmap of hashed binary keys, of fixed size however many keys there are.

    Keys that are there are always found; others at a rate that grows with the
    number of keys. So texts without a hit need no join, and only the others are
    shuffled to the keys themselves.
    """

    def __init__(self, keys: DataFrame, key: str, scratch: Scratch):
        at = self._at(F.col(key)).alias("at")
        maps = (
            keys.select(at)
            .groupBy(F.call_function("div", F.col("at"), F.lit(_BITMAP)).alias("part"))
            .agg(
                F.call_function(
                    "bitmap_construct_agg", F.col("at") % _BITMAP
                ).alias("bitmap")
            )
        )
        self.maps = scratch.stage(maps, "key-filter")

    @staticmethod
    def _at(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS))

    def mark(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with a column that is true where the key may be there."""
        part, bitmap = (free_name(df.columns, n) for n in ("filter_part", "filter_bitmap"))
        maps = F.broadcast(self.maps.select(F.col("part").alias(part), F.col("bitmap").alias(bitmap)))
        at = self._at(F.col(key))
        keyed = df.withColumn(part, F.call_function("div", at, F.lit(_BITMAP)))
        bit = (at % _BITMAP).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), F.call_function("div", bit, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10)
        hit = F.call_function("getbit", byte.cast("int"), bit % 8) == 1
        marked = keyed.join(maps, part, "left")
        return marked.withColumn(name, F.coalesce(hit, F.lit(False))).drop(part, bitmap)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once.

    Inside a lambda an outer expression would be computed anew for every
    element; bound to a variable of an outer lambda it is not.
    """
    return F.element_at(F.transform(F.array(value), use), 1)
