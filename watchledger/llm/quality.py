"""A quality classifier: naive Bayes support vectors over n-gram indicators.

A text is the set of its features: which byte n-grams occur in it, which pairs
of word shapes, and in which band its share of repeated words and lines lies.
Every feature is hashed to one of ``2 ** 18`` places. A place's weight is the
log of the ratio of its smoothed frequencies among good and poor documents; the
scaled indicators, at unit length, go to a linear hinge-loss model that is fit
by dual coordinate descent. A logistic curve on margins of documents that the
model has not seen turns margins into scores.

The class counts cover every labelled training row, or about ``LABEL_ROWS`` of them
by a hash of the id where there are more; each task adds up its own and sends at
most one row per place. The support vectors are fit on at most
``FIT_ROWS`` training rows, those with the smallest hashes of their ids, in one
task. A model has a fixed size, so it is sent to all tasks whole.

Labels, languages, sources and ids are no features.

Defined cases: a null or empty text has the features of no words and gets a
score like any other. A document that is labelled more than once counts as poor
if any label says so; a label without a document, or a null label or id, is
left out. Without training rows of both kinds every score is 1 (nothing is
rejected). Rows that repeat score alike. Only ids and texts are read.
"""

from __future__ import annotations

import bisect
import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchledger.llm.common import LABEL_ROWS, free_name, held_out, label_sample, scratch_for, ship_package
from watchledger.scratch import Scratch

BITS = 18
PLACES = 1 << BITS
FIT_ROWS = 6000
PASSES = 12
PENALTY = 1.0
FOLDS = 3
THRESHOLD = 0.7
#: Odd factors, one for each length of byte n-grams.
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_BANDS = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
_KINDS = bytes(
    97 if 97 <= c <= 122 or c > 127 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57
    else 32 if 9 <= c <= 13 else c
    for c in range(256)
)
_CHUNK = 1 << 20


# -- features ----------------------------------------------------------------


def _band(share: float) -> int:
    return bisect.bisect(_BANDS, share)


def _marks(text: bytes) -> set[bytes]:
    """Features of words and lines: shapes, pairs of shapes, repetition.

    A word's shape has one character for each run of lower-case, upper-case,
    digit, or equal other characters.
    """
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    kinds = np.frombuffer(text.translate(_KINDS), np.uint8)
    runs = kinds[np.flatnonzero(kinds[1:] != kinds[:-1]) + 1].tobytes()
    shapes = (bytes(kinds[:1]) + runs).split()
    marks = {*shapes, *map(b" ".join, zip(shapes, shapes[1:]))}
    n = max(len(words), 1)
    pairs = len(set(zip(words, words[1:])))
    shares = (
        sum(map(operator.eq, words, words[1:])) / n,
        1 - pairs / max(len(words) - 1, 1),
        1 - len(set(lines)) / max(len(lines), 1),
        len(set(shapes)) / n,
    )
    marks.update(b"= %d %d" % (i, _band(share)) for i, share in enumerate(shares))
    marks.add(b"=size %d" % min(len(words), 1 << 14).bit_length())
    return marks


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=values[:1] ^ 1))]


def features(text: bytes | None) -> np.ndarray:
    """The sorted places of one text's features."""
    text = text or b""
    shift = np.uint32(32 - BITS)
    found = np.fromiter(map(zlib.crc32, _marks(text)), np.uint32) >> shift
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data), _CHUNK):
        piece = data[at : at + _CHUNK + 3].astype(np.uint32)
        code = np.zeros(len(piece), np.uint32)
        parts = [found]
        for n, factor in enumerate(_FACTORS[: len(piece)], 1):
            code = (code[: len(piece) - n + 1] << np.uint32(8)) | piece[n - 1 :]
            parts.append(((code + np.uint32(n)) * factor) >> shift)
        found = _distinct(np.concatenate(parts))
    return _distinct(found).astype(np.int32)


# -- the model ---------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Weight per place, with the ratios multiplied in; and the curve."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: bool = False

    def margin(self, places: np.ndarray) -> float:
        if not len(places):
            return self.bias
        scaled = self.ratios[places]
        length = float(np.sqrt(scaled @ scaled)) or 1.0
        return float(scaled @ self.weights[places]) / length + self.bias

    def score(self, places: np.ndarray) -> float:
        if self.constant:
            return 1.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(places) + self.shift, -30, 30))))


def log_ratios(good: np.ndarray, poor: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    p, q = good + smoothing, poor + smoothing
    return np.log((p / p.sum()) / (q / q.sum())).astype(np.float32)


def dual_coordinate_descent(
    rows: list[np.ndarray],
    values: list[np.ndarray],
    labels: np.ndarray,
    penalty: float = PENALTY,
    passes: int = PASSES,
    seed: int = 1,
) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised linear model of the hinge loss.

    ``min |w|^2 / 2 + sum C_i max(0, 1 - y_i w x_i)``: one dual variable per row
    is set to its best value in [0, C_i] at a time, and ``w`` follows. The bias
    is a feature that is 1 everywhere. Classes weigh alike as a whole.
    """
    random = np.random.default_rng(seed)
    weights, bias = np.zeros(PLACES, np.float64), 0.0
    duals = np.zeros(len(rows))
    share = np.where(labels > 0, (labels > 0).mean(), (labels < 0).mean())
    limits = penalty * 0.5 / share
    norms = np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(passes):
        moved = 0.0
        for i in random.permutation(len(rows)):
            x, y = values[i], labels[i]
            slack = y * (float(weights[rows[i]] @ x) + bias) - 1
            new = min(max(duals[i] - slack / norms[i], 0.0), limits[i])
            step = (new - duals[i]) * y
            if step:
                weights[rows[i]] += step * x
                bias += step
                moved = max(moved, abs(step))
                duals[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def logistic_curve(margins: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve, slightly regularised."""
    x = np.column_stack([margins, np.ones(len(margins))])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (good - p) - 1e-2 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(rows: list[np.ndarray], good: np.ndarray, ratios: np.ndarray) -> Model:
    """Fit the support vectors, and the curve on margins across folds."""
    scaled = [ratios[r].astype(np.float64) for r in rows]
    values = [v / (np.sqrt(v @ v) or 1.0) for v in scaled]
    labels = np.where(good, 1.0, -1.0)
    fold = np.arange(len(rows)) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        seen = np.flatnonzero(fold != k)
        w, b = dual_coordinate_descent([rows[i] for i in seen], [values[i] for i in seen], labels[seen])
        for i in np.flatnonzero(fold == k):
            margins[i] = w[rows[i]] @ values[i] + b
    slope, shift = logistic_curve(margins, good.astype(float))
    w, b = dual_coordinate_descent(rows, values, labels)
    return Model(ratios, w.astype(np.float32), b, slope, shift)


# -- Spark jobs --------------------------------------------------------------


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of the labels that are not held out, one row per id."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.min("quality") == 1).alias("good"))
    )


def class_counts(rows: DataFrame) -> DataFrame:
    """(place, good, poor): in how many texts of each class a feature occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, PLACES + 1), np.int64)
        for batch in batches:
            for text, good in zip(batch["text"], batch["good"]):
                side = counts[int(good)]
                side[features(_bytes(text))] += 1
                side[PLACES] += 1
        places = np.flatnonzero(counts.sum(axis=0))
        yield pd.DataFrame({"place": places, "good": counts[1, places], "poor": counts[0, places]})

    parts = rows.select("text", "good").mapInPandas(run, "place long, good long, poor long")
    return parts.groupBy("place").agg(F.sum("good").alias("good"), F.sum("poor").alias("poor"))


def _bytes(text: object) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def fit_sample(docs: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """(doc_id, good, text) of at most ``limit`` ids, those of smallest hash.

    The ids are chosen first, without texts, so that no text is sorted; they
    are few enough by their limit to be sent to every task.
    """
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "good").agg(F.min("text").alias("text"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    scratch: Scratch | None = None,
    label_rows: int = LABEL_ROWS,
) -> Model:
    """Learn from labelled documents that are not held out, about ``label_rows``."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = scratch_for(spark, scratch)
    known = scratch.stage(training_labels(labels), "training-labels")
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    counts = np.zeros((2, PLACES + 1))
    found = class_counts(texts.join(label_sample(known, label_rows), "doc_id")).toPandas()
    counts[1, found["place"]], counts[0, found["place"]] = found["good"], found["poor"]
    constant = Model(np.zeros(PLACES, np.float32), np.zeros(PLACES, np.float32), 0.0, 0.0, 0.0, True)
    if not counts[:, PLACES].all():
        return constant
    ratios = log_ratios(counts[1, :PLACES], counts[0, :PLACES])
    shared = spark.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [
            pd.DataFrame({
                "id": batch["doc_id"],
                "good": batch["good"],
                "places": [features(_bytes(t)) for t in batch["text"]],
            })
            for batch in batches
        ]
        if not parts:
            return
        seen = pd.concat(parts).sort_values("id")
        good = seen["good"].to_numpy(bool)
        if good.all() or not good.any():
            return
        model = fit(list(seen["places"]), good, shared.value)
        tail = [model.bias, model.slope, model.shift]
        used = np.flatnonzero(model.weights)
        yield pd.DataFrame(
            {
                "place": np.concatenate([used, [-3, -2, -1]]),
                "weight": np.concatenate([model.weights[used], tail]).astype(float),
            }
        )

    sample = fit_sample(docs, known, fit_rows).repartition(1)
    fitted = sample.mapInPandas(run, "place long, weight double").toPandas()
    if fitted.empty:
        return constant
    weights = np.zeros(PLACES, np.float32)
    at = dict(zip(fitted["place"], fitted["weight"]))
    bias, slope, shift = (float(at[k]) for k in (-3, -2, -1))
    kept = fitted[fitted["place"] >= 0]
    weights[kept["place"]] = kept["weight"]
    return Model(ratios, weights, bias, slope, shift)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with two more columns, ``score`` and ``predicted``."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.score(features(_bytes(t))) for t in texts], dtype=float)

    names = [free_name(docs.columns, n) for n in ("score", "predicted")]
    scored = docs.select(*[F.col(f"`{c}`") for c in docs.columns], score("text").alias(names[0]))
    return scored.select("*", (F.col(names[0]) >= threshold).cast("int").alias(names[1]))


def keep_predicted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    scored = score_documents(docs, model, threshold)
    kept = scored.where(F.col(f"`{scored.columns[-1]}`") == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
