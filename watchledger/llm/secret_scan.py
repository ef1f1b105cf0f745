"""Secret scans: fixed patterns and sliding-window entropy, in Spark functions.

A scan finds spans in code points, end exclusive, leftmost and non-overlapping
per kind. Positions come from splitting a text by a pattern and adding up the
lengths of pieces and matches.

``assign``, ``access`` and ``hex`` are patterns. ``entropy`` takes candidate
strings and slides a window over each. A window is judged by the classes of
characters that a generator of keys would draw from: hexadecimal digits, and
base 64. Windows that lie within a run of hexadecimal digits have their
threshold, wherever in the candidate the run is; so a name or path glued to a
key does not hide it. The entropy of a window of ``w`` characters is
``log2(w) - S / w`` with ``S`` the sum of ``c * log2(c)`` over the counts ``c``
of its characters. Counts and ``S`` are carried from window to window: moving on by
one character changes two counts, and ``S`` by two differences. A candidate with a window that
reaches its class's threshold is a span, unless the allow-list has the candidate
or the run.

Time and memory grow in proportion to a text: lists that grow match by match are
built in blocks, and a text is cut into blocks before pieces are taken out of it.

Defined cases: a null or empty text has no spans and hashes the empty string.
Rows are judged one by one, so repeats give the same result. Only the text
column is read; redaction returns the documents' own columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import free_name, let

# The patterns of the result's contract. Matches of ``access`` and
# ``hex`` are whole runs, so their least length can stand in the pattern; a
# failing ``assign`` match still uses up its text, so its length is judged later.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Patterns of candidates that are no secrets: words, plain numbers, paths and
#: rulers of one repeated character, and universally unique identifiers.
ALLOW = (
    r"[A-Za-z]+",
    r"[0-9]+",
    r"[A-Za-z]+([/_=-]+[A-Za-z]+)*[/_=-]*",
    r"[/_=+-]+",
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
)


@dataclass(frozen=True)
class CharacterClass:
    """What a key is drawn from, and the entropy in bits that gives it away."""

    name: str
    pattern: str
    threshold: float


CLASSES = (
    CharacterClass("hexadecimal", r"[0-9A-Fa-f]+", 3.0),
    CharacterClass("base64", r"[A-Za-z0-9+/_=-]+", 3.7),
)
WINDOW = 20
PLACEHOLDER = "[SECRET]"
#: Elements of a list, and characters of a text, that are handled together.
BLOCK, BLOCK_TEXT = 256, 1024
_SPANS = "array<struct<start:int,kind:int,end:int,hit:string>>"


def _no_spans() -> Column:
    return F.array().cast(_SPANS)


def _collected(items: Column, step, kind: str) -> Column:
    """The list that ``step(at, item)`` makes, an (at, made) pair for each item.

    ``made`` is a list of none or a few elements of type ``kind``. Appending copies
    what is there, so elements are appended within blocks, and blocks to a list.
    """
    empty = F.array().cast(f"array<{kind}>")

    def one(state: Column, item: Column) -> Column:
        return let(
            step(state["at"], item),
            lambda made: F.struct(
                made["at"].alias("at"), F.concat(state["made"], made["made"]).alias("made")
            ),
        )

    def block(state: Column, start: Column) -> Column:
        inside = F.aggregate(
            F.slice(items, start, F.lit(BLOCK)),
            F.struct(state["at"].alias("at"), empty.alias("made")),
            one,
        )
        return let(
            inside,
            lambda b: F.struct(
                b["at"].alias("at"), F.concat(state["made"], F.array(b["made"])).alias("made")
            ),
        )

    starts = F.when(
        F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))
    ).otherwise(F.array().cast("array<int>"))
    nothing = F.struct(
        F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("made")
    )
    return F.aggregate(starts, nothing, block)


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """(start, kind, end, hit) of every match; null where there is none."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # Before each match; what follows the last one is left over by the zip.
    pieces = F.split(text, pattern, -1)
    parts = F.arrays_zip(pieces.alias("piece"), hits.alias("hit"))
    element = _SPANS.removeprefix("array<").removesuffix(">")

    def step(at: Column, part: Column) -> Column:
        start = at + F.length(part["piece"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        one = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            end.alias("end"),
            part["hit"].alias("hit"),
        )
        made = F.when(part["hit"].isNotNull(), F.array(one)).otherwise(_no_spans())
        return F.struct(end.alias("at"), made.alias("made"))

    found = let(parts, lambda p: F.flatten(_collected(p, step, element)["made"]))
    return F.when(text.rlike(pattern), found)


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The largest entropy of any window, in bits; of the whole text if shorter."""

    def numbered(chars: Column) -> Column:
        def by_number(symbols: Column) -> Column:
            codes = F.transform(chars, lambda c: F.array_position(symbols, c).cast("int"))
            return let(codes, lambda c: _entropy(c, F.size(symbols), window))

        return let(F.array_distinct(chars), by_number)

    return let(F.filter(F.split(text, ""), lambda c: c != ""), numbered)


def _entropy(codes: Column, symbols: Column, window: int) -> Column:
    """The same for characters given as numbers from 1 to ``symbols``."""
    width = F.least(F.size(codes), F.lit(window))
    weighted = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])

    def cost(n: Column) -> Column:
        return F.element_at(weighted, n + 1)

    first = F.slice(codes, F.lit(1), width)
    counts = F.transform(
        F.sequence(F.lit(1), symbols), lambda s: F.size(F.filter(first, lambda c: c == s))
    )

    def slid(begun: Column) -> Column:
        start = F.aggregate(begun, F.lit(0.0), lambda total, n: total + cost(n))

        def slide(state: Column, at: Column) -> Column:
            # The window from ``at`` on loses its first character and gains the
            # one after its last.
            gone, new = F.element_at(codes, at), F.element_at(codes, at + width)
            n_gone = F.element_at(state["counts"], gone)
            n_new = F.element_at(state["counts"], new)
            total = state["sum"] - cost(n_gone) + cost(n_gone - 1) - cost(n_new) + cost(n_new + 1)
            sum_ = F.when(gone == new, state["sum"]).otherwise(total)
            moved = F.transform(
                state["counts"],
                lambda n, i: n
                + F.when(i + 1 == new, 1).otherwise(0)
                - F.when(i + 1 == gone, 1).otherwise(0),
            )
            return F.struct(
                F.when(gone == new, state["counts"]).otherwise(moved).alias("counts"),
                sum_.alias("sum"),
                F.least(state["least"], sum_).alias("least"),
            )

        steps = F.size(codes) - width
        state = F.struct(begun.alias("counts"), start.alias("sum"), start.alias("least"))
        walked = F.aggregate(F.sequence(F.lit(1), steps), state, slide)
        return F.when(steps > 0, walked["least"]).otherwise(start)

    entropy = F.log2(width.cast("double")) - let(counts, slid) / width
    return F.when(width > 0, entropy).otherwise(0.0)


def is_random(
    candidate: Column,
    classes: Sequence[CharacterClass] = CLASSES,
    window: int = WINDOW,
    allow: Sequence[str] = ALLOW,
) -> Column:
    """Not allowed, with a run of some class that has enough entropy in a window.

    A run is judged as if it stood alone, so the allow-list holds for it too. It
    is as long as a window at least, or the whole of a shorter candidate.
    """
    width = F.least(F.length(candidate), F.lit(window))

    def gives_away(each: CharacterClass):
        return lambda run: (
            (F.length(run) >= width)
            & ~_allowed(run, allow)
            & (window_entropy(run, window) >= each.threshold)
        )

    found = F.lit(False)
    for each in classes:
        runs = F.regexp_extract_all(candidate, F.lit(each.pattern), F.lit(0))
        found = found | F.exists(runs, gives_away(each))
    return F.when(_allowed(candidate, allow), False).otherwise(found)


def _allowed(text: Column, allow: Sequence[str]) -> Column:
    allowed = F.lit(False)
    for pattern in allow:
        allowed = allowed | text.rlike(f"^(?:{pattern})$")
    return allowed


def secret_spans(
    text: Column,
    classes: Sequence[CharacterClass] = CLASSES,
    window: int = WINDOW,
    allow: Sequence[str] = ALLOW,
) -> Column:
    """All spans of a text by start, then kind: start, kind (its place), end, hit."""
    assign = F.filter(
        spans_of(text, ASSIGN, "assign"),
        lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= ASSIGN_VALUE,
    )
    access = spans_of(text, ACCESS, "access")
    hexes = spans_of(text, HEX, "hex")
    entropy = F.filter(
        spans_of(text, CANDIDATE, "entropy"),
        lambda s: is_random(s["hit"], classes, window, allow),
    )
    parts = [F.coalesce(part, _no_spans()) for part in (assign, access, hexes, entropy)]
    return F.array_sort(F.concat(*parts))


def scan_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with one more column, ``spans``."""
    name = free_name(docs.columns, "spans")
    found = secret_spans(F.coalesce(F.col(text), F.lit("")), **options)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], found.alias(name))


def listed(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    wanted = F.array(*[F.lit(KINDS.index(k)) for k in kinds])
    picked = F.filter(spans, lambda s: F.array_contains(wanted, s["kind"]))
    return F.array_join(
        F.transform(
            picked,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, spans: Column, placeholder: str = PLACEHOLDER) -> Column:
    """The text with every stretch that spans cover replaced once.

    Spans are in order of start. Pieces are taken out of blocks of the text, so that
    no search for a position starts at the text's beginning, and joined once.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_TEXT}}}"), F.lit(0))

    def written(cut: Column) -> Column:
        def piece(start: Column, end: Column) -> Column:
            a, b = (F.call_function("div", x, F.lit(BLOCK_TEXT)).cast("int") for x in (start, end))
            head = F.coalesce(F.get(cut, a), F.lit(""))
            tail = F.coalesce(F.get(cut, b), F.lit(""))
            whole = F.array_join(F.slice(cut, a + 2, F.greatest(b - a - 1, F.lit(0))), "")
            return F.when(
                a == b, F.substring(head, start % BLOCK_TEXT + 1, end - start)
            ).otherwise(
                F.concat(
                    F.substring(head, start % BLOCK_TEXT + 1, F.lit(BLOCK_TEXT)),
                    whole,
                    F.substring(tail, F.lit(1), end % BLOCK_TEXT),
                )
            )

        def step(at: Column, span: Column) -> Column:
            # ``at`` is how far the text is written.
            fresh = F.array(piece(at, span["start"]), F.lit(placeholder))
            made = F.when(span["start"] >= at, fresh).otherwise(F.array().cast("array<string>"))
            return F.struct(F.greatest(at, span["end"]).alias("at"), made.alias("made"))

        return let(
            _collected(spans, step, "string"),
            lambda walked: F.concat(
                F.array_join(F.flatten(walked["made"]), ""), piece(walked["at"], F.length(text))
            ),
        )

    return F.when(F.size(spans) > 0, let(blocks, written)).otherwise(text)


def redact_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with their secrets replaced; a null text stays null.

    A column ``n_chars`` is counted again for changed texts.
    """
    scanned = scan_documents(docs, text, **options)
    spans = F.col(f"`{scanned.columns[-1]}`")
    made = free_name(scanned.columns, "clean")
    # Under a name of its own: within lambdas, a new column that is called like
    # the text would be taken for the text.
    clean = scanned.select("*", redacted(F.col(text), spans).alias(made))
    columns = []
    for field in docs.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name == text:
            column = F.col(made)
        elif field.name == "n_chars":
            counted = F.length(F.col(made)).cast(field.dataType)
            column = F.when(F.size(spans) > 0, counted).otherwise(column)
        columns.append(column.alias(field.name))
    return clean.select(*columns)
