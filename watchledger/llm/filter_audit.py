"""What each filter of a chain removes, in every order the chain can have.

A document is known by the set of filters that it fails. The number removed by a
set of filters, whatever their order, is the number of documents that fail one of
them. This game over the 32 coalitions of five filters says everything:

- A step removes the difference between the coalition with its filter and the
  coalition before it.
- The Hart-Mas-Colell potential P of a coalition S, with P of none being 0, is
  (v(S) + the sum of P(S without i) over i in S) / |S|. A filter's Shapley value
  is P(all) - P(all without it). Potentials are kept as multiples of 1/n!, in
  which they are whole; the value times n! is then the filter's removals summed
  over all orders.

The documents are read once and reduced to counts per part and set of failed
filters. "Repeats a smaller id's text" is a property of a group, which is found by
counting: per digest the rows with the smallest id, and the rest. So no document
meets its group, and a text may be that of any share of the documents.

Defined cases: a null text, part or name counts as empty. A document without an
id repeats nothing and has no labels. A label that is there several times counts
once, and 1 wins over 0 and null. Repeated rows are documents of their own; rows
with the smallest id of their text repeat nothing. An empty table has no parts and
gives no rows. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.llm.common import WORD

#: The filter that needs the whole table, by its letter in the orders.
REPEAT = "E"
COUNTS = ("kept", "removed", "redundant", "unique_fails")


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a single text fails, by letter."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": capitals * 100 > F.length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def tally(
    docs: DataFrame,
    failures: Mapping[str, Column],
    labels: DataFrame,
    outcomes: Mapping[str, Column],
    part: str = "lang",
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Counts per part and set of failed filters.

    Columns part, failed (bit i for the i-th of ``failures``, the next bit for a
    repeated text), documents, and one count per outcome, a condition on labels.
    """
    failed = sum(
        (F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(failures.values())),
        F.lit(0),
    )
    rows = docs.select(
        F.col(id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)).alias("digest"),
        failed.alias("failed"),
    )
    same = rows.groupBy("id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
    # Rows without an id are dealt by their digest and meet no label.
    key = F.concat(F.lit("id:"), F.col("id").cast("string"))
    keyed = same.withColumn(
        "key", F.coalesce(key, F.concat(F.lit("text:"), F.hex("digest")))
    )
    met = [F.max(F.coalesce(c, F.lit(False))).alias(name) for name, c in outcomes.items()]
    labelled = (
        labels.where(F.col(id).isNotNull())
        .groupBy(F.concat(F.lit("id:"), F.col(id).cast("string")).alias("key"))
        .agg(*met)
    )
    known = keyed.join(labelled, "key", "left")
    group = ["part", "failed", *outcomes]
    # An id is once per digest, part and set here, so the smallest brings its count.
    parts = known.groupBy("digest", *group).agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("low"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
    )
    least = F.min("low.id").over(Window.partitionBy("digest"))
    firsts = parts.withColumn("least", least).withColumn(
        "first",
        F.col("unnamed")
        + F.when(F.col("low.id") == F.col("least"), F.col("low.n")).otherwise(F.lit(0)),
    )
    repeat = 1 << len(failures)
    split = F.explode(
        F.array(
            F.struct(F.col("failed").alias("failed"), F.col("first").alias("n")),
            F.struct((F.col("failed") + repeat).alias("failed"), (F.col("n") - F.col("first")).alias("n")),
        )
    )
    halves = firsts.select("part", *outcomes, split.alias("half")).where("half.n > 0")
    count = F.col("half.n")
    return halves.groupBy("part", F.col("half.failed").alias("failed")).agg(
        F.sum(count).alias("documents"),
        *[F.coalesce(F.sum(F.when(F.col(o), count)), F.lit(0)).alias(o) for o in outcomes],
    )


def audit(tallied: DataFrame, letters: str, outcomes: Sequence[str] = ()) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of the step.

    ``letters`` names the bits of ``failed``. Further columns: one per outcome,
    how many of its documents the step removes.
    """
    n, full = len(letters), (1 << len(letters)) - 1
    measures = ["documents", *outcomes]
    by_set = [
        F.map_from_entries(F.collect_list(F.struct("failed", m))).alias(m) for m in measures
    ]
    games = tallied.groupBy("part").agg(*by_set)
    for m in measures:
        games = games.withColumn(f"{m}_won", _coalitions(F.col(m), full))
    games = games.withColumn("potential", _potentials(F.col("documents_won"), n))

    orders = ["".join(p) for p in itertools.permutations(letters)]
    steps = games.withColumn(
        "filter_order", F.explode(F.array(*[F.lit(o) for o in orders]))
    ).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    placed = steps.withColumn(
        "before", _bits(F.expr("left(filter_order, step - 1)"), letters)
    ).withColumn("filter", _bits(F.expr("substr(filter_order, step, 1)"), letters))

    def value(game: str, coalition: Column) -> Column:
        return F.col(game)[coalition]

    before, filter, won = F.col("before"), F.col("filter"), "documents_won"
    after = before.bitwiseOR(filter)
    everything = F.aggregate(F.map_values("documents"), F.lit(0).cast("long"), lambda a, x: a + x)
    removed = value(won, after) - value(won, before)
    others = F.lit(full).bitwiseXOR(filter)
    shapley = value("potential", F.lit(full)) - value("potential", others)
    return placed.select(
        "part",
        "filter_order",
        "step",
        (everything - value(won, after)).alias("kept"),
        removed.alias("removed"),
        (value(won, filter) - removed).alias("redundant"),
        (value(won, F.lit(full)) - value(won, others)).alias("unique_fails"),
        *[(value(f"{o}_won", after) - value(f"{o}_won", before)).alias(o) for o in outcomes],
        shapley.alias("shapley"),
    )


def _bits(text: Column, letters: str) -> Column:
    """The set of the letters in a text, as bits."""
    bits = [text.contains(x).cast("int") * (1 << i) for i, x in enumerate(letters)]
    return sum(bits[1:], bits[0])


def _coalitions(by_set: Column, full: int) -> Column:
    """For each coalition, how many documents fail one of its filters."""

    def won(coalition: Column) -> Column:
        return F.aggregate(
            F.map_entries(by_set),
            F.lit(0).cast("long"),
            lambda total, e: total
            + F.when(e["key"].bitwiseAND(coalition) != 0, e["value"]).otherwise(F.lit(0)),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(full)), won)


def _potentials(won: Column, n: int) -> Column:
    """Each coalition's potential times n!, from those with one filter less."""

    def next_one(made: Column, coalition: Column) -> Column:
        smaller = [
            F.when(
                coalition.bitwiseAND(F.lit(1 << i)) != 0,
                F.get(made, coalition.bitwiseXOR(F.lit(1 << i))),
            ).otherwise(F.lit(0))
            for i in range(n)
        ]
        total = sum(smaller, F.get(won, coalition) * math.factorial(n))
        return F.array_append(made, F.call_function("div", total, F.bit_count(coalition)))

    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), start, next_one)
