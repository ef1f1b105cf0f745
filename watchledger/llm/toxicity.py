"""Toxicity by a classifier chain over word indicators.

A text's features are its words, the beginnings of its longer words, and
whether two, three or four of its words share a beginning, so that inflected
and compound words count too.

The categories are predicted one after the other by linear logistic models. A
later model also gets the probabilities of the earlier ones. While it is being
fit, those come from models that have not seen the row (out of fold), so that it
does not learn to trust probabilities that are better than they will be.

Features are chosen by their chi-square statistic with any category, counted over
all labelled training rows, or about ``LABEL_ROWS`` of them by a hash of the id
where there are more. The models are fit on at most ``FIT_ROWS`` of those
rows, the ones with the smallest hashes of their ids, in one task. Vocabulary
and models have fixed sizes, so they are sent to all tasks whole.

Defined cases: a null or empty text has no words and is scored like any other.
A document labelled more than once has a category if any label says so; a null
label says no; labels without a document or id are left out. A category that no
training row has, or all have, gets its plain frequency as probability. Without
training rows every probability is 0. Rows that repeat score alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import (
    LABEL_ROWS,
    free_name,
    held_out,
    label_sample,
    scratch_for,
    ship_package,
)
from watchledger.scratch import Scratch

VOCABULARY = 1000
LEAST_TEXTS = 5
FIT_ROWS = 16_000
FOLDS = 3
PENALTY = 1.0
THRESHOLD = 0.3
PREFIXES = (4, 6)
_WORD = re.compile(r"[^\W_]+")


def features(text: object) -> set[str]:
    """Words, beginnings as ``abcd*``, and shared ones as ``abcd*2`` to ``*4``."""
    words = set(_WORD.findall(text.lower())) if isinstance(text, str) else set()
    found = set(words)
    for size in PREFIXES:
        starts = Counter(w[:size] for w in words if len(w) > size)
        for start, n in starts.items():
            found.add(f"{start}*")
            found.update(f"{start}*{k}" for k in range(2, min(n, 4) + 1))
    return found


# -- the chain ---------------------------------------------------------------


@dataclass(frozen=True)
class Linear:
    """Weights of words and of the earlier categories' probabilities."""

    words: np.ndarray
    earlier: np.ndarray
    bias: float


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


class Rows:
    """Word indicators of many rows, as flat (row, word) places."""

    def __init__(self, words: Sequence[np.ndarray], size: int):
        self.count, self.size = len(words), size
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.row = np.repeat(np.arange(self.count), lengths)
        self.word = np.concatenate([*words, np.empty(0, np.int64)]).astype(np.int64)

    def of(self, picked: np.ndarray) -> "Rows":
        place = np.full(self.count, -1)
        place[picked] = np.arange(len(picked))
        kept = place[self.row] >= 0
        part = Rows([], self.size)
        part.count, part.row, part.word = len(picked), place[self.row[kept]], self.word[kept]
        return part

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.word], self.count)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, values[self.row], self.size)


def fit_linear(
    rows: Rows, earlier: np.ndarray, labels: np.ndarray, penalty: float = PENALTY
) -> Linear:
    """Regularised logistic regression by Newton steps, each solved by
    conjugate gradients. The bias is not regularised."""
    size, extra = rows.size, earlier.shape[1]
    share = labels.mean() if len(labels) else 0.0
    start = float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share else -30.0)
    if not 0 < share < 1:
        return Linear(np.zeros(size), np.zeros(extra), start)
    w = np.zeros(size + extra + 1)
    w[-1] = start
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6

    def times(v: np.ndarray) -> np.ndarray:
        return rows.times(v[:size]) + earlier @ v[size:-1] + v[-1]

    def back(v: np.ndarray) -> np.ndarray:
        return np.concatenate([rows.back(v), earlier.T @ v, [v.sum()]])

    def loss(v: np.ndarray) -> float:
        m = times(v)
        return float(np.logaddexp(0, m).sum() - labels @ m + 0.5 * (ridge * v * v).sum())

    now = loss(w)
    for _ in range(15):
        p = _probability(times(w))
        slope = back(p - labels) + ridge * w
        curve = p * (1 - p)
        step, rest = np.zeros_like(w), -slope
        way, size_ = rest.copy(), rest @ rest
        first = size_
        for _ in range(25):
            bent = back(curve * times(way)) + ridge * way
            far = size_ / (way @ bent)
            step += far * way
            rest = rest - far * bent
            new = rest @ rest
            if new < 1e-6 * first:
                break
            way, size_ = rest + (new / size_) * way, new
        scale = 1.0
        while scale > 1e-4 and (then := loss(w + scale * step)) > now:
            scale /= 2
        if scale <= 1e-4 or now - then < 1e-6 * abs(now):
            break
        w, now = w + scale * step, then
    return Linear(w[:size], w[size:-1], float(w[-1]))


def fit_chain(rows: Rows, labels: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """One model per category (a column of ``labels``), in order."""
    earlier = np.empty((rows.count, 0))
    chain = []
    fold = np.arange(rows.count) % folds
    for j in range(labels.shape[1]):
        chain.append(fit_linear(rows, earlier, labels[:, j]))
        unseen = np.zeros(rows.count)
        for k in range(folds):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            model = fit_linear(rows.of(inside), earlier[inside], labels[inside, j])
            unseen[outside] = predict(model, rows.of(outside), earlier[outside])
        earlier = np.column_stack([earlier, unseen])
    return chain


def predict(model: Linear, rows: Rows, earlier: np.ndarray) -> np.ndarray:
    return _probability(rows.times(model.words) + earlier @ model.earlier + model.bias)


def predict_chain(chain: Sequence[Linear], rows: Rows) -> np.ndarray:
    """Probabilities, one column per category."""
    found = np.empty((rows.count, 0))
    for model in chain:
        found = np.column_stack([found, predict(model, rows, found)])
    return found


# -- Spark jobs --------------------------------------------------------------


@dataclass(frozen=True)
class Chain:
    """What scoring needs: categories, the place of each word, the models."""

    categories: tuple[str, ...]
    words: dict[str, int]
    models: tuple[Linear, ...]

    def places(self, text: object) -> np.ndarray:
        found = features(text)
        return np.fromiter(sorted(self.words[w] for w in found if w in self.words), np.int64)


def known_categories(labels: DataFrame, categories: dict[str, Column]) -> DataFrame:
    """(doc_id, a 0/1 column per category), one row per id, none held out."""
    flags = [
        F.max(F.coalesce(column.cast("int"), F.lit(0))).alias(name)
        for name, column in categories.items()
    ]
    rows = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return rows.groupBy("doc_id").agg(*flags)


def choose_words(
    docs: DataFrame,
    known: DataFrame,
    categories: Sequence[str],
    size: int,
    least: int,
    scratch: Scratch,
    label_rows: int = LABEL_ROWS,
) -> list[str]:
    """The words whose texts differ most from others in some category.

    A row for each distinct word of a text is added up before it is shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, np.ndarray] = {"": np.zeros(len(categories) + 1, np.int64)}
            for text, *flags in zip(batch["text"], *(batch[c] for c in categories)):
                one = np.array([1, *flags], np.int64)
                for word in {"", *features(text)}:
                    if word in counts:
                        counts[word] += one
                    else:
                        counts[word] = one.copy()
            table = np.array(list(counts.values()))
            columns = {f"c{j}": table[:, j] for j in range(table.shape[1])}
            yield pd.DataFrame({"word": list(counts), **columns})

    names = [f"c{j}" for j in range(len(categories) + 1)]
    schema = "word string, " + ", ".join(f"{n} long" for n in names)
    counted = (
        docs.select("doc_id", "text")
        .join(label_sample(known, label_rows), "doc_id")
        .select("text", *categories)
        .mapInPandas(run, schema)
        .groupBy("word")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    counted = scratch.stage(counted, "word-counts")
    total = counted.where("word = ''").select(*[F.col(n).alias(f"t{n}") for n in names])
    totals = total.first()
    if totals is None:
        return []
    n, with_word = F.lit(float(totals[0])), F.col("c0").cast("double")
    best = F.lit(0.0)
    for j in range(1, len(names)):
        have, both = F.lit(float(totals[j])), F.col(names[j]).cast("double")
        off = n * both - with_word * have
        spread = with_word * (n - with_word) * have * (n - have)
        best = F.greatest(best, F.when(spread > 0, off * off / spread).otherwise(0.0))
    chosen = (
        counted.where((F.col("word") != "") & (F.col("c0") >= least))
        .select("word", best.alias("best"))
        .orderBy(F.desc("best"), "word")
        .limit(size)
    )
    return [row["word"] for row in chosen.select("word").collect()]


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, Column],
    vocabulary: int = VOCABULARY,
    least_texts: int = LEAST_TEXTS,
    fit_rows: int = FIT_ROWS,
    scratch: Scratch | None = None,
    label_rows: int = LABEL_ROWS,
) -> Chain:
    """Learn the categories, in their order, from rows that are not held out."""
    spark = docs.sparkSession
    ship_package(spark)
    names = tuple(categories)
    scratch = scratch_for(spark, scratch)
    known = scratch.stage(known_categories(labels, categories), "training-labels")
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    words = choose_words(texts, known, names, vocabulary, least_texts, scratch, label_rows)
    empty = Chain(names, {w: i for i, w in enumerate(words)}, ())
    shared = spark.sparkContext.broadcast(empty)
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(fit_rows)
    sample = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", *names)
        .agg(F.min("text").alias("text"))
    )

    def indicators(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = [shared.value.places(t) for t in batch["text"]]
            yield batch.drop(columns="text").assign(places=places)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts or not sum(map(len, parts)):
            return
        seen = pd.concat(parts).sort_values("doc_id")
        size = len(shared.value.words)
        chain = fit_chain(Rows(list(seen["places"]), size), seen[list(names)].to_numpy(float))
        yield pd.DataFrame(
            {
                "category": range(len(chain)),
                "words": [m.words for m in chain],
                "earlier": [m.earlier for m in chain],
                "bias": [m.bias for m in chain],
            }
        )

    flags = ", ".join(f"`{n}` int" for n in names)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInPandas(indicators, f"doc_id {id_type}, {flags}, places array<long>")
    fitted = rows.repartition(1).mapInPandas(
        fit, "category int, words array<double>, earlier array<double>, bias double"
    )
    models = [
        Linear(np.array(r["words"]), np.array(r["earlier"], float), r["bias"])
        for r in sorted(fitted.collect(), key=lambda r: r["category"])
    ]
    return Chain(names, empty.words, tuple(models))


def score_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """The documents with the probability of each category."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(chain)
    names = chain.categories

    @F.pandas_udf("array<double>")
    def score(texts: pd.Series) -> pd.Series:
        chain = shared.value
        if not chain.models:
            return pd.Series([[0.0] * len(names)] * len(texts))
        rows = Rows([chain.places(t) for t in texts], len(chain.words))
        return pd.Series(list(predict_chain(chain.models, rows)))

    made = free_name(docs.columns, "probabilities")
    scored = docs.select(*[F.col(f"`{c}`") for c in docs.columns], score("text").alias(made))
    columns = [
        F.col(made)[j].alias(free_name(docs.columns, name)) for j, name in enumerate(names)
    ]
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns], *columns)
