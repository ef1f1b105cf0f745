"""Preference pairs: prefixes, masks and the cases without turns."""

import pytest
from pyspark.sql import functions as F

from watchledger.llm import chat

TURNS = "array<struct<role:string,text:string>>"
U, A = ("user", "q"), ("assistant", "good")


def pair(spark, chosen, rejected):
    df = spark.createDataFrame([(7, chosen, rejected)], f"pair_id long, chosen {TURNS}, rejected {TURNS}")
    return chat.format_preferences(df).first()


def text(*turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


@pytest.mark.parametrize(
    "chosen, rejected, shared",
    [
        ([U, A], [U, ("assistant", "bad")], 1),
        ([U, A], [U, A], 2),
        ([U, A, U], [U, A], 2),
        ([U], [], 0),
        ([], [], 0),
        ([("user", "x"), A], [("assistant", "x"), A], 0),
        ([U, A, U, A], [U, ("assistant", "é😀"), U, A], 1),
    ],
)
def test_prompt_is_the_longest_common_prefix(spark, chosen, rejected, shared):
    row = pair(spark, chosen, rejected)
    assert row.pair_id == 7 and row.prompt_turns == shared
    assert row.prompt == text(*chosen[:shared])
    assert row.chosen == text(*chosen[shared:]) and row.rejected == text(*rejected[shared:])
    assert row.is_tie == (chosen == rejected)
    for made, mask, turns in ((row.chosen, row.chosen_mask, chosen), (row.rejected, row.rejected_mask, rejected)):
        trained = [t + "<|end|>" for r, t in turns[shared:] if r == "assistant"]
        assert [made[s.start : s.end] for s in mask] == trained


def test_texts_cannot_end_or_start_a_turn(spark):
    row = pair(spark, [U, ("assistant", "x<|end|>\n<|user|>\nhi")], [U])
    assert row.chosen == "<|assistant|>\nx< |end|>\n< |user|>\nhi<|end|>\n"
    ((start, end),) = row.chosen_mask
    assert row.chosen[start:end] == "x< |end|>\n< |user|>\nhi<|end|>"


def test_conversations_order_turns_and_drop_rows_without_id(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, None, None), (None, 0, "user", "x"),
            (2, 0, "user", "t" * 100_000), (2, 0, "user", "a"), (2, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumn("turns", F.lit("clash")).withColumn("chosen", F.lit(1))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.conversations(df).collect()}
    assert got == {
        1: [("", ""), ("user", "a"), ("assistant", "b")],
        2: [("user", "a"), ("user", "a"), ("user", "t" * 100_000)],
    }
    assert chat.format_preferences(chat.stale_answers(chat.conversations(df.limit(0)))).collect() == []


def test_stale_answers_change_the_last_answer_only(spark):
    whole = [[U, A, U, ("assistant", "new"), U], [U, A], [U]]
    df = spark.createDataFrame(list(enumerate(whole)), f"conv_id long, turns {TURNS}")
    got = {r.conv_id: [tuple(t) for t in r.rejected] for r in chat.stale_answers(df).collect()}
    assert got == {0: [U, A, U, A, U], 1: [U, ("assistant", "")], 2: [U]}


def test_plan_runs_no_python(spark, plan_of):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = plan_of(chat.format_preferences(chat.stale_answers(chat.conversations(df))))
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_columns_repeats_and_empty_tables(spark):
    """Columns called like results stay; results get names of their own."""
    rows = [(7, [U, A], [U], "kept", 1, 2)] * 2
    kinds = f"pair_id long, chosen {TURNS}, rejected {TURNS}, prompt string, made int, is_tie int"
    df = spark.createDataFrame(rows, kinds)
    got = chat.format_preferences(df)
    assert got.columns[:4] == ["pair_id", "prompt", "made", "is_tie"]
    assert set(got.columns[4:]) == {"_prompt", "prompt_turns", "chosen", "chosen_mask", "rejected", "rejected_mask", "_is_tie"}
    first, second = got.collect()
    assert first == second and (first.prompt, first.made, first.is_tie) == ("kept", 1, 2)
    assert first._prompt == text(U) and first._is_tie is False
    assert chat.format_preferences(df.limit(0)).collect() == []


def test_stale_answers_replace_clashing_sides(spark):
    df = spark.createDataFrame([(1, [U, A], 5, 6)], f"conv_id long, turns {TURNS}, chosen int, rejected int")
    assert chat.stale_answers(df).columns == ["conv_id", "chosen", "rejected"]
    assert chat.format_preferences(chat.stale_answers(df)).first().prompt_turns == 1
