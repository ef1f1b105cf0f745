"""Repair of conversations by the cheapest edits that make turns alternate.

A repaired conversation is empty, or an optional system turn followed by pairs of
a user and an assistant turn. Turns may be kept (K, free), given another role (R),
deleted (D), and empty turns inserted (I). Blank and duplicate turns must go; a
truncated turn that stays costs extra. Of the cheapest repairs the one whose
letters, in order, come first in ASCII is taken.

The search is a depth-first branch and bound with a stack of its own. A node is
the number of turns dealt with and the role that came last. Its bound is the least
cost of what is left, taken from the end backwards without regard to letters.
Children are tried in the order of their letters, so that an equally cheap repair
found later comes later in ASCII: the incumbent gives way only to a lower cost, and
a node's entry in the dominance table cuts off every later prefix that is not
cheaper. The search ends when the stack is empty.

A conversation may hold any share of the rows. Rows are numbered over sorted
ranges, which cut a long conversation into stretches of at most ``STRETCH`` rows.
Of each row one letter goes into its stretch (role and fault). Stretches are
searched one by one, once for each role they may begin and end with, and a fold
over the stretches picks the cheapest chain; a fold sees one letter per row, as the
result does. Duplicates are found by counting, not by a set per conversation. The
repaired turns are streamed in order and never held together.

Defined cases: rows are taken by turn, null first; rows of one turn by role, then
text. A null role or text is one blank, and a null id is a conversation like any
other. A role counts by its first letter; an empty role has none and cannot be
kept. Repeated rows are turns of their own, later ones duplicates. Long texts are
not held beside each other. Only the four columns are read, so further columns may
have any name. An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.llm.common import scratch_for, ship_package
from watchledger.operators import number_rows
from watchledger.scratch import Scratch

# Costs of the edits, and what a truncated turn that stays adds.
RETURN_ROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a conversation that are searched together.
STRETCH = 4096
ROLES = ("system", "user", "assistant")
FILLED = r"[^\x20\x09-\x0D]"
CUT_OFF = r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z"
FINE, BLANK, DUPLICATE, CUT = range(4)

# What came last: nothing, a system, a user or an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (NOTHING, ASSISTANT)
#: The turn that may follow besides a system turn at the very start.
NEXT = (USER, USER, ASSISTANT, USER)
_FAR = 1 << 60


# -- search ------------------------------------------------------------------


def _insertions() -> list[list[int]]:
    """Least cost of getting from one state to another by inserted turns alone."""
    cost = [[_FAR] * 4 for _ in STATES]
    for start in STATES:
        state, spent = start, 0
        while cost[start][state] == _FAR:
            cost[start][state] = spent
            state, spent = NEXT[state], spent + INSERT
    return cost


INSERTIONS = _insertions()


def row_edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row, by letter."""
    fault, role = divmod(code, 4)
    edits = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return edits
    extra = TRUNCATED if fault == CUT else 0
    follows = NEXT[state]
    fits = role + 1 == follows or (state == NOTHING and role + 1 == SYSTEM)
    if fits:
        edits.append(("K", extra, role + 1))
    if role + 1 != follows:
        edits.append(("R", RETURN_ROLE + extra, follows))
    return edits


EDITS = [[row_edits(code, state) for state in STATES] for code in range(16)]


def suffix_bounds(codes: list[int], end: int) -> list[list[int]]:
    """Least cost from each row and state on to ``end``."""
    bounds = [[INSERTIONS[state][end] for state in STATES]]
    for code in reversed(codes):
        after, edits = bounds[-1], EDITS[code]
        direct = [min(cost + after[to] for _, cost, to in edits[s]) for s in STATES]
        bounds.append([min(map(sum, zip(INSERTIONS[s], direct))) for s in STATES])
    bounds.reverse()
    return bounds


def search(codes: list[int], start: int, end: int) -> tuple[int, str] | None:
    """The cheapest edits from one state to another, and the first such in ASCII."""
    bounds = suffix_bounds(codes, end)
    if bounds[0][start] >= _FAR:
        return None
    incumbent_cost, incumbent = bounds[0][start] + 1, None
    seen: dict[int, int] = {}  # dominance: the least cost a node was reached with
    stack: list[tuple[int, int, int, tuple | None]] = [(0, start, 0, None)]
    while stack:
        at, state, cost, path = stack.pop()
        node = 4 * at + state
        if cost + bounds[at][state] >= incumbent_cost or cost >= seen.get(node, _FAR):
            continue
        seen[node] = cost
        if at == len(codes) and state == end:
            incumbent_cost, incumbent = cost, path
            continue
        children = [("I", INSERT, NEXT[state], at)]
        if at < len(codes):
            children += [(x, c, to, at + 1) for x, c, to in EDITS[codes[at]][state]]
        for letter, extra, to, row in sorted(children, reverse=True):
            stack.append((row, to, cost + extra, (letter, path)))
    return incumbent_cost, _spelled(incumbent)


def _spelled(path: tuple | None) -> str:
    letters = []
    while path:
        letter, path = path
        letters.append(letter)
    return "".join(reversed(letters))


def search_stretch(codes: str, first: bool, last: bool) -> tuple[list[int], list[str]]:
    """Cost and letters for each pair of states, at ``4 * start + end``; -1 for none."""
    rows = [int(c, 16) for c in codes]
    costs, letters = [-1] * 16, [""] * 16
    for start in (NOTHING,) if first else STATES:
        for end in ENDS if last else STATES:
            found = search(rows, start, end)
            if found is not None:
                costs[4 * start + end], letters[4 * start + end] = found
    return costs, letters


Chain = tuple[str, "Chain"] | None


def spelled_before(a: Chain, b: Chain) -> bool:
    """Whether the letters of chain ``a`` come before those of ``b``."""
    left = right = ""
    while True:
        if a is b and left == right:
            return False
        while not left and a:
            left, a = a
        while not right and b:
            right, b = b
        if not left or not right:
            return not left and bool(right)
        n = min(len(left), len(right))
        if left[:n] != right[:n]:
            return left[:n] < right[:n]
        left, right = left[n:], right[n:]


def fold(tables: list[tuple[list[int], list[str]]]) -> tuple[int, list[str]]:
    """Least cost over all stretches, and the letters of each."""
    best: dict[int, tuple[int, Chain]] = {end: (0, None) for end in ENDS}
    for costs, letters in reversed(tables):
        before: dict[int, tuple[int, Chain]] = {}
        for start in STATES:
            for end, (rest, chain) in best.items():
                if costs[4 * start + end] < 0:
                    continue
                cost, made = costs[4 * start + end] + rest, (letters[4 * start + end], chain)
                held = before.get(start)
                if held is None or cost < held[0] or (
                    cost == held[0] and spelled_before(made, held[1])
                ):
                    before[start] = cost, made
        best = before
    cost, chain = best[NOTHING]
    pieces = []
    while chain:
        piece, chain = chain
        pieces.append(piece)
    return cost, pieces


# -- rows to stretches -------------------------------------------------------


def in_order(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns n, conv_id, turn, role, text; ``n`` counts conversations in order."""
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    key = [F.asc_nulls_last("conv_id"), F.asc_nulls_first("turn")]
    # Role and text in one, as the zero character sorts before all others; the
    # first letters do for the borders.
    said = F.concat_ws("\0", "role", "text")
    return number_rows(rows, [*key, "role", "text"], scratch, "n", [*key, F.left(said, F.lit(64))])


def coded(rows: DataFrame) -> DataFrame:
    """Columns n, conv_id, role number and fault of each row of ``in_order``."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    key = F.unhex(F.sha2(said.cast("binary"), 256))
    initial = F.left("role", F.lit(1))
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2)
    facts = rows.select(
        "n",
        "conv_id",
        role.otherwise(3).alias("role"),
        F.col("text").rlike(FILLED).alias("filled"),
        F.col("text").rlike(CUT_OFF).alias("cut"),
        key.alias("key"),
    )
    # A row is no duplicate if its number is the least of its role and text.
    firsts = facts.groupBy("conv_id", "key").agg(F.min("n").alias("n"))
    seen = facts.join(firsts.select("n", F.lit(True).alias("first")), "n", "left")
    return seen.select(
        "n",
        "conv_id",
        "role",
        F.when(~F.col("filled"), BLANK)
        .when(F.col("first").isNull(), DUPLICATE)
        .when(F.col("cut"), CUT)
        .otherwise(FINE)
        .alias("fault"),
    )


def stretches(codes: DataFrame) -> DataFrame:
    """Letters of up to ``STRETCH`` rows of a conversation, in order."""
    letter = F.lower(F.hex(F.col("fault") * 4 + F.col("role")))
    listed = F.array_sort(F.collect_list(F.struct("n", letter.alias("letter"))))
    cut = codes.groupBy("conv_id", F.floor(F.col("n") / STRETCH).alias("at")).agg(
        listed.alias("rows"),
        *[
            F.count_if(F.col("fault") == fault).alias(name)
            for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))
        ],
    )
    by_order = Window.partitionBy("conv_id").orderBy("at")
    return cut.select(
        "conv_id",
        F.col("rows")[0]["n"].alias("n"),
        F.array_join("rows.letter", "").alias("codes"),
        F.lag("at").over(by_order).isNull().alias("is_first"),
        F.lead("at").over(by_order).isNull().alias("is_last"),
        "blank",
        "duplicate",
        "truncated",
    )


#: Initials that may stand beside each other, by their numbers.
LEGAL = {(0, 1), (1, 2), (2, 1)}


def broken_pairs(codes: str) -> int:
    roles = [int(c, 16) % 4 for c in codes]
    return sum(pair not in LEGAL for pair in zip(roles, roles[1:]))


def _with_columns(df: DataFrame, added: dict[str, pa.DataType], names: str, compute) -> DataFrame:
    """``df`` with columns that ``compute(batch)`` gives as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(batch)
            arrays = [pa.array(made[name], kind) for name, kind in added.items()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], [*batch.schema.names, *added]
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kept}, {names}")


def _search_batch(batch: pa.RecordBatch) -> dict[str, list]:
    columns = [batch.column(name).to_pylist() for name in ("codes", "is_first", "is_last")]
    known: dict[tuple, tuple] = {}
    found = []
    for row in zip(*columns):
        if row not in known:
            known[row] = search_stretch(*row)
        found.append(known[row])
    return {
        "costs": [costs for costs, _ in found],
        "letters": [letters for _, letters in found],
        "broken": [broken_pairs(codes) for codes in columns[0]],
    }


def _fold_batch(batch: pa.RecordBatch) -> dict[str, list]:
    costs, pieces, broken = [], [], []
    for parts in batch.column("parts").to_pylist():
        cost, letters = fold([(p["costs"], p["letters"]) for p in parts])
        costs.append(cost)
        pieces.append(letters)
        seams = zip(parts, parts[1:])
        broken.append(sum(broken_pairs(a["ends"][-1] + b["ends"][0]) for a, b in seams))
    return {"cost": costs, "pieces": pieces, "seams": broken}


def searched(cut: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit and the plan.

    ``plan`` holds per stretch the number of its first row and its letters.
    """
    ship_package(cut.sparkSession)
    # Dealt anew, as a long conversation's stretches came together for their order.
    solved = _with_columns(
        cut.repartition("conv_id", "n"),
        {
            "costs": pa.list_(pa.int64()),
            "letters": pa.list_(pa.string()),
            "broken": pa.int64(),
        },
        "costs array<long>, letters array<string>, broken long",
        _search_batch,
    )
    counts = ("blank", "duplicate", "truncated", "broken")
    ends = F.concat(F.left("codes", F.lit(1)), F.right("codes", F.lit(1)))
    whole = solved.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("n", ends.alias("ends"), "costs", "letters"))
        ).alias("parts"),
        *[F.sum(name).alias(name) for name in counts],
    )
    folded = _with_columns(
        whole,
        {"cost": pa.int64(), "pieces": pa.list_(pa.string()), "seams": pa.int64()},
        "cost long, pieces array<string>, seams long",
        _fold_batch,
    )
    plan = F.zip_with(
        "parts", "pieces", lambda p, x: F.struct(p["n"].alias("n"), x.alias("letters"))
    )
    return folded.select(
        "conv_id",
        "blank",
        "duplicate",
        "truncated",
        (F.col("broken") + F.col("seams")).alias("illegal"),
        "cost",
        F.array_join("pieces", "").alias("audit"),
        plan.alias("plan"),
    )


# -- repaired turns ----------------------------------------------------------

_TURN = pa.schema(
    [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
)


class _Walk:
    """Applies letters to rows; both come in order, letters before their rows."""

    def __init__(self):
        self.begin(None)

    def begin(self, conv_id) -> None:
        self.conv_id, self.state, self.place, self.letters, self.next = conv_id, NOTHING, 0, "", 0

    def plan(self, letters: str) -> list[tuple]:
        left = self.inserted()
        self.letters, self.next = letters, 0
        return left

    def inserted(self) -> list[tuple]:
        """The inserted turns that come now."""
        made = []
        while self.letters[self.next : self.next + 1] == "I":
            self.next += 1
            made.append(self._turn("I", NEXT[self.state], ROLES[NEXT[self.state] - 1], ""))
        return made

    def row(self, role: str, text: str) -> list[tuple]:
        made = self.inserted()
        letter = self.letters[self.next]
        self.next += 1
        if letter == "K":
            system = self.state == NOTHING and role.startswith("s")
            made.append(self._turn("K", SYSTEM if system else NEXT[self.state], role, text))
        elif letter == "R":
            follows = NEXT[self.state]
            made.append(self._turn("R", follows, ROLES[follows - 1], text))
        return made

    def _turn(self, edit: str, state: int, role: str, text: str) -> tuple:
        self.state = state
        self.place += 1
        return self.conv_id, self.place, edit, role, text


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, place, edit, role, text.

    A conversation's turns are in one partition, in order. The rows pass by one
    after the other, so that a conversation may be larger than memory.
    """
    ship_package(rows.sparkSession)
    steps = found.select("conv_id", F.explode("plan").alias("step")).select(
        "conv_id", F.col("step.n").alias("n"), F.col("step.letters").alias("letters")
    )
    both = rows.select("conv_id", "n", "role", "text").unionByName(steps, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id"), "n", F.asc_nulls_last("letters")
    )
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, started, kind = _Walk(), False, None
        for batch in batches:
            made: list[tuple] = []
            kind = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "letters")]
            for conv_id, role, text, letters in zip(*columns):
                if not started or conv_id != walk.conv_id:
                    made += walk.inserted()
                    walk.begin(conv_id)
                    started = True
                made += walk.plan(letters) if letters is not None else walk.row(role, text)
            yield _turns(made, kind)
        if started:
            yield _turns(walk.inserted(), kind)

    return ordered.mapInArrow(
        run, f"conv_id {id_type}, place long, edit string, role string, text string"
    )


def _turns(made: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    schema = pa.schema([("conv_id", id_type), *_TURN])
    columns = list(zip(*made)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def digest_turns(turns: DataFrame) -> DataFrame:
    """SHA-256 of the ``role:text`` lines of each conversation of ``repaired_turns``.

    It must follow that function directly: it relies on its order.
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, kind = None, None, None
        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for conv_id, role, text in zip(*columns):
                if digest is None or conv_id != current:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _digests(done, kind)
        if digest is not None:
            yield _digests([(current, digest.hexdigest())], kind)

    return turns.mapInArrow(run, f"conv_id {id_type}, repaired_sha256 string")


def _digests(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    ids, digests = zip(*done) if done else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, id_type), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"]
    )


def repair(turns: DataFrame, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(audits, turns after repair) of conversations.

    An audit has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    scratch = scratch_for(turns.sparkSession, scratch)
    rows = in_order(turns, scratch)
    found = scratch.stage(searched(stretches(coded(rows))), "audits")
    spans = rows.groupBy("conv_id").agg(
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)
        ).alias("gaps")
    )
    audits = together([found.drop("plan"), spans], "conv_id")
    return audits, repaired_turns(rows, found)


def together(parts: list[DataFrame], key: str) -> DataFrame:
    """Tables with at most one row per key side by side; null is a key."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy(key).agg(*[F.max(c).alias(c) for c in union.columns if c != key])


# -- damage ------------------------------------------------------------------

KINDS = 20
DROP, EMPTY, UNPOINTED, REPEAT, AS_USER = range(5)


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with faults that follow from each row's id and turn alone.

    Nulls in id and turn count as one blank in the draw, and a null role or text
    becomes one. Columns conv_id, turn, role, text.
    """
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), blank),
    )
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        (F.crc32(key.cast("binary")) % KINDS).alias("kind"),
    )
    text: Column = (
        F.when(F.col("kind") == EMPTY, "")
        .when(F.col("kind") == UNPOINTED, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("kind") == REPEAT, 2).otherwise(1)
    return rows.where(F.col("kind") != DROP).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == AS_USER, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    ).drop("copy")
