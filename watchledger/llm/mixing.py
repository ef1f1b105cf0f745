"""Mix sources to target weights by repeating documents.

The words of each source are summed, targets follow from weights and caps, and
a document is emitted ``floor(rate)`` times plus one more time if a draw seeded
by its id falls below the fraction, where ``rate = target / size of source``.

Defined cases: a null text has no words; a null source is a source of its own,
last in order; a document without an id draws by its text; rows with the same
id share the draw. A source without words has target 0 and emits nothing. An
empty table gives an empty result. ``mix_sources`` returns the documents' own
columns, whatever they are called; ``mix_plan`` adds columns under ``prefix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watchledger.llm.common import free_name, scratch_for, unit_draw, word_count
from watchledger.scratch import Scratch

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 17


def source_sizes(docs: DataFrame, size: Column, source: str = "source") -> DataFrame:
    """(source, source_size), summed on the map side first."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(size).cast("long").alias("source_size")
    )


def cycle_weights(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Give sources, by code point and null last, the weights in turn."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sizes.withColumn(
        "weight", F.element_at(cycle, ((place - 1) % len(weights) + 1).cast("int"))
    )


def targets(weighted: DataFrame, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """Share ``share`` of all words by weight; no source gets over cap x its size.

    What a capped source leaves is shared again by weight. That is one level for
    all sources: with sources in order of cap by weight, the level if all before
    this one were full rises while they are and falls afterwards, so the level
    that holds is the largest. One row per source is all that is windowed.
    """
    most = F.col("source_size") * float(cap)
    order = W.orderBy((most / F.col("weight")), F.col("source").asc_nulls_last())
    before = F.coalesce(
        F.sum(most).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    everything = F.sum("source_size").over(W.partitionBy()) * float(share)
    levels = weighted.select("*", ((everything - before) / rest).alias("level"))
    level = F.max("level").over(W.partitionBy())
    return levels.select(
        "source",
        "source_size",
        F.least(most, level * F.col("weight")).alias("target"),
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.0,
    cap: float = CAP,
    seed: int = SEED,
    prefix: str = "mix_",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Each document with its size, its source's size and target, and copies."""
    scratch = scratch_for(docs.sparkSession, scratch)
    place = free_name(docs.columns, "source_of_target")
    sized = source_sizes(docs, word_count(F.col("text")))
    plan = scratch.stage(
        targets(cycle_weights(sized, weights), share, cap).select(
            F.col("source").alias(place),
            F.col("source_size").alias(f"{prefix}source_size"),
            F.col("target").alias(f"{prefix}target"),
        ),
        "mix-targets",
    )
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(*names, word_count(F.col("text")).alias(f"{prefix}size"))
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col(place)), "left")
    size, target = F.col(f"{prefix}source_size"), F.col(f"{prefix}target")
    rate = F.when(size > 0, target / size).otherwise(0.0)
    by_text = F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    key = F.coalesce(F.col("doc_id").cast("string"), by_text)
    extra = F.when(unit_draw(seed, key) < rate - F.floor(rate), 1).otherwise(0)
    return joined.select(
        *names,
        f"{prefix}size",
        size,
        target,
        (F.floor(rate) + extra).cast("int").alias(f"{prefix}copies"),
    )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each as many times as the plan says."""
    while any(c.startswith(options.get("prefix", "mix_")) for c in docs.columns):
        options["prefix"] = "_" + options.get("prefix", "mix_")
    prefix = options.get("prefix", "mix_")
    planned = mix_plan(docs, **options)
    names = [F.col(f"`{c}`") for c in docs.columns]
    copies = F.array_repeat(F.lit(1), F.col(f"{prefix}copies"))
    one = f"{prefix}copy"
    return planned.select(*names, F.explode(copies).alias(one)).drop(one)
