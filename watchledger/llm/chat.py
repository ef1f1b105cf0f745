"""Preference pairs as chat text: one prompt, two masked completions.

Chosen and rejected conversations are compared turn by turn. Their longest
common prefix is rendered once as the prompt; what follows it is rendered for
each of them, with a mask of the spans that a model is trained on, which are the
assistant's texts with their end marks. Everything is made of array functions on
one row per pair, so a pair's turns must fit in a row, as its rendered text must
in any case.

Turns are in order of their number, then role, then text. A turn's text cannot
end a turn or start one: ``<|`` in it is written ``< |``.

Defined cases: a null role or text is empty; null turn numbers come first. A
turn without a conversation id belongs to no conversation. Conversations that
are equal are a tie: the prompt holds all turns and the completions are empty. A
pair of which one side has no turns has an empty prompt. Repeated rows are turns
of their own. Only the named columns are read; other columns are kept, and a result
whose name is taken gets underscores in front. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import free_name, let

ASSISTANT = "assistant"
END = "<|end|>"
_SPANS = "array<struct<start:int,end:int>>"
FORMATTED = (
    "prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask", "is_tie",
)


def conversations(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """(id, turns): the turns of each conversation in order, as role and text."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = F.array_sort(F.collect_list(turn))
    return (
        turns.where(F.col(id_column).isNotNull())
        .groupBy(id_column)
        .agg(
            F.transform(
                ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
            ).alias("turns")
        )
    )


def common_prefix(a: Column, b: Column) -> Column:
    """How many turns two arrays of turns start with in common."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first_other = F.array_position(same, False)
    return F.when(first_other == 0, F.size(a)).otherwise(first_other - 1).cast("int")


def _clean(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), _clean(role), F.lit("|>\n"))


def render(turns: Column) -> Column:
    """Turns as text."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(_head(t["role"]), _clean(t["text"]), F.lit(END + "\n")),
        ),
        "",
    )


def loss_spans(turns: Column, trained: str = ASSISTANT) -> Column:
    """(start, end) in characters of what is trained on in ``render(turns)``."""

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_head(turn["role"]))
        end = start + F.length(_clean(turn["text"])) + len(END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        grown = F.concat(state["spans"], span)
        return F.struct(
            (end + 1).alias("at"),
            F.when(turn["role"] == trained, grown).otherwise(state["spans"]).alias("spans"),
        )

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(turns, nothing, step)["spans"]


def format_preferences(
    pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected"
) -> DataFrame:
    """Each pair with its prompt, both completions and their masks.

    ``pairs`` holds two arrays of turns per row; its other columns are kept.
    """
    a, b = F.col(chosen), F.col(rejected)

    def after(turns: Column, shared: Column) -> Column:
        return F.slice(turns, shared + 1, F.size(turns))

    def formatted(shared: Column) -> Column:
        return F.struct(
            shared.alias("prompt_turns"),
            render(F.slice(a, F.lit(1), shared)).alias("prompt"),
            render(after(a, shared)).alias("chosen"),
            loss_spans(after(a, shared)).alias("chosen_mask"),
            render(after(b, shared)).alias("rejected"),
            loss_spans(after(b, shared)).alias("rejected_mask"),
            ((F.size(a) == shared) & (F.size(b) == shared)).alias("is_tie"),
        )

    kept = [c for c in pairs.columns if c not in (chosen, rejected)]
    others = [F.col(f"`{c}`") for c in kept]
    made, name = let(common_prefix(a, b), formatted), free_name(kept, "made")
    whole = pairs.select(*others, F.explode(F.array(made)).alias(name))
    # A column that has a result's name stays, and the result gets a free one.
    results = [F.col(f"`{name}`.{f}").alias(free_name(kept, f)) for f in FORMATTED]
    return whole.select(*others, *results)


def stale_answers(conversations_: DataFrame) -> DataFrame:
    """Pairs of each conversation and a worse one derived from it.

    The worse one gives its last answer's turn the text of the answer before,
    or no text if there is none. Without any answer both sides are equal. Columns
    called like the two sides give way to them.
    """
    turns = F.col("turns")

    def answers(whole: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(whole))
        return F.filter(places, lambda i: F.element_at(whole, i)["role"] == ASSISTANT)

    def worse(at: Column) -> Column:
        last = F.element_at(at, -1)
        before = F.when(
            F.size(at) > 1, F.element_at(turns, F.element_at(at, -2))["text"]
        ).otherwise("")
        changed = F.transform(
            turns,
            lambda t, i: F.struct(
                t["role"].alias("role"),
                F.when(i + 1 == last, before).otherwise(t["text"]).alias("text"),
            ),
        )
        return F.when(F.size(at) > 0, changed).otherwise(turns)

    others = [
        F.col(f"`{c}`") for c in conversations_.columns if c not in ("turns", "chosen", "rejected")
    ]
    return conversations_.select(
        *others, turns.alias("chosen"), let(answers(turns), worse).alias("rejected")
    )


def listed(spans: Column) -> Column:
    """``start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
