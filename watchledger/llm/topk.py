"""Exact top-k search by inner product with ball trees.

Vectors are dealt to cells by the nearest of at most ``PIVOTS`` pivots (a bounded
sample by a hash of the id, one per full shard until then), and a cell to shards of bounded size by a hash of the
id, so that a cell may hold any part of all rows. A task builds a ball tree over a
shard: every node has a centre and a radius, and no vector in it has an inner
product with ``q`` above ``q . centre + |q| * radius``. A search takes the nodes in
falling order of their bounds and stops at the first that cannot reach the query's
kth score.

Every query is first searched in one shard of the cell whose pivot suits it best,
which gives it a kth score that is already close. It then goes to the shards of
those cells only whose ball reaches that score, and starts from it there. Queries
pass a shard's tree in a stream: what is moved is every vector once and every kept
pair of query and shard, for each of the two searches, and a task holds one shard
and one batch of queries.

Scores are whole-number inner products of doubles, exact while sums stay below
2 ** 53. Ties go to the smaller id.

Defined cases: vectors that are null, or hold a null or a component that is not
finite, take no part; neither do vectors without an id. An id that repeats
stands for the smallest of its vectors (in order of components). A vector that
is shorter than others is filled up with zeros. With fewer candidates than k a
query gets all of them; with none it has no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watchledger.llm.common import scratch_for, ship_package
from watchledger.scratch import Scratch

SHARD_ROWS = 8192
BLOCK_ROWS = 4096
LEAF_ROWS = 128
PIVOTS = 256

#: More shards than these share tasks.
MOST_TASKS = 20_000


def upper_bounds(
    queries: np.ndarray, norms: np.ndarray, centres: np.ndarray, radii: np.ndarray
) -> np.ndarray:
    """The most that a vector of each ball can score, a row per query."""
    with np.errstate(invalid="ignore", over="ignore"):
        bound = queries @ centres.T + norms[:, None] * radii[None, :]
        bound += np.abs(bound) * 1e-12
    # Sums beyond a double exclude nothing.
    return np.where(np.isnan(bound), np.inf, bound)


def _norms(rows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((rows**2).sum(axis=1))


def _radius(distance: float) -> float:
    """A little more than the distance, for rounding."""
    return distance * (1 + 1e-9) + 1e-9


# -- one shard ---------------------------------------------------------------


class BallTree:
    """Centres, radii and children of nodes; leaves are slices of the rows."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.arange(len(rows))
        self.centres, self.radii, self.children, self.slices = [], [], [], []
        todo = [(0, len(rows), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            node = len(self.radii)
            own = rows[order[start:end]]
            centre = own.mean(axis=0)
            self.centres.append(centre)
            self.radii.append(_radius(_norms(own - centre).max()))
            self.children.append([-1, -1])
            self.slices.append((start, end))
            if parent >= 0:
                self.children[parent][side] = node
            if end - start > leaf_rows:
                far = own[((own - centre) ** 2).sum(axis=1).argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                across = own @ (other - far)
                # By rank, so that equal vectors are halved too.
                order[start:end] = order[start:end][np.argsort(across, kind="stable")]
                middle = (start + end) // 2
                todo += [(start, middle, node, 0), (middle, end, node, 1)]
        self.rows, self.ids = rows[order], ids[order]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Bounds of all nodes, none above that of the node it belongs to."""
        bound = upper_bounds(queries, _norms(queries), self.centres, self.radii)
        # A node has a smaller number than its children.
        for node, children in enumerate(self.children):
            for child in children:
                if child >= 0:
                    np.minimum(bound[:, child], bound[:, node], out=bound[:, child])
        return bound


class Best:
    """The k best (score, id) of each query, and its kth score so far."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.query = np.empty(0, np.int64)
        self.score, self.id = np.empty(0), np.empty(0, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        score = np.concatenate([self.score, score])
        id_ = np.concatenate([self.id, id_])
        order = np.lexsort((id_, -score, query))
        query, score, id_ = query[order], score[order], id_[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query)))
        kept = place < self.k
        self.query, self.score, self.id = query[kept], score[kept], id_[kept]
        kth = place == self.k - 1
        self.least[query[kth]] = np.maximum(self.least[query[kth]], score[kth])


def search_shard(
    tree: BallTree, queries: np.ndarray, ids: np.ndarray, least: np.ndarray, k: int
) -> Best:
    """The k best of one shard for each query, none below its ``least``.

    All queries go down the tree at once, each by its own order of nodes.
    """
    best = Best(len(queries), k, least)
    bounds = tree.bounds(queries)
    # The best bound first; a node comes before its children.
    order = np.argsort(-bounds, axis=1, kind="stable")
    is_leaf = np.array([left < 0 for left, _ in tree.children])
    active = np.arange(len(queries))
    for turn in range(bounds.shape[1]):
        node = order[active, turn]
        # Bounds fall from turn to turn, so a query that is out stays out.
        open_ = bounds[active, node] >= best.least[active]
        active, node = active[open_], node[open_]
        if not len(active):
            break
        asking, leaf = active[is_leaf[node]], node[is_leaf[node]]
        if not len(asking):
            continue
        hits = []
        by_leaf = np.argsort(leaf, kind="stable")
        edges = np.flatnonzero(np.diff(leaf[by_leaf], prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:]):
            some = asking[by_leaf[a:b]]
            start, end = tree.slices[leaf[by_leaf[a]]]
            scores = queries[some] @ tree.rows[start:end].T
            q, v = np.nonzero(
                (scores >= best.least[some][:, None])
                & (ids[some][:, None] != tree.ids[start:end][None, :])
            )
            hits.append((some[q], scores[q, v], tree.ids[start:end][v]))
        best.add(*(np.concatenate(x) for x in zip(*hits)))
    return best


# -- Spark jobs --------------------------------------------------------------


def finite_vectors(
    rows: DataFrame, id_column: str, vector_column: str, component
) -> DataFrame:
    """(id, vector of doubles), one row per id."""
    vector = F.col(vector_column)
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != math.inf),
    )
    usable = rows.where(F.col(id_column).isNotNull() & vector.isNotNull() & finite)
    return (
        usable.select(
            F.col(id_column).cast("long").alias("id"),
            F.transform(vector, component).alias("vector"),
        )
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Cells:
    """Pivots with the radius, the rows and the shards of their cells."""

    def __init__(self, pivots: np.ndarray, shard_rows: int):
        self.pivots, self.shard_rows = pivots, shard_rows
        self.width = pivots.shape[1]

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore", over="ignore"):
            return ((self.pivots**2).sum(axis=1) / 2 - rows @ self.pivots.T).argmin(axis=1)

    def measure(self, found: dict[int, tuple[int, float]]) -> None:
        """Take in (rows, largest distance) by cell; empty cells have no shard."""
        every = [found.get(cell, (0, 0.0)) for cell in range(len(self.pivots))]
        self.rows = np.array([rows for rows, _ in every])
        self.radii = np.array([_radius(far) for _, far in every])
        self.shards = -(-self.rows // self.shard_rows)
        self.first = np.concatenate([[0], np.cumsum(self.shards)])


def _dealt(cells: Cells):
    """Add the nearest pivot and the distance from it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = _matrix(batch["vector"], cells.width)
            cell = cells.nearest(rows)
            yield batch.assign(cell=cell, distance=_norms(rows - cells.pivots[cell]))

    return run


def _at_home(cells: Cells, k: int):
    """Add the first shard of each query, in the cell whose pivot scores most.

    Cells with more than k rows are preferred, as others give no kth score.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some = cells.rows > (k if (cells.rows > k).any() else 0)
        choice = np.flatnonzero(some)
        for batch in batches:
            scores = _matrix(batch["vector"], cells.width) @ cells.pivots[choice].T
            cell = choice[np.nan_to_num(scores, nan=-np.inf).argmax(axis=1)]
            salt = batch["salt"].to_numpy(np.int64) % cells.shards[cell]
            yield batch[["id", "vector"]].assign(shard=cells.first[cell] + salt, least=-np.inf)

    return run


def _elsewhere(cells: Cells):
    """Each query once for every other shard whose cell reaches its kth score."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = _matrix(batch["vector"], cells.width)
            bound = upper_bounds(asked, _norms(asked), cells.pivots, cells.radii)
            open_ = bound >= batch["least"].to_numpy()[:, None]
            home = batch["shard"].to_numpy()
            for cell in range(len(cells.pivots)):
                for shard in range(cells.first[cell], cells.first[cell + 1]):
                    kept = batch[open_[:, cell] & (home != shard)]
                    if len(kept):
                        yield kept.assign(shard=shard)

    return run


def _searched(k: int, leaf_rows: int, block_rows: int, width: int):
    """The best of each shard: its vectors come first, queries pass after them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, tree, held = None, None, []
        for batch in batches:
            for key, rows in batch.groupby("shard", sort=False):
                if key != shard:
                    shard, tree, held = key, None, []
                is_query = rows["is_query"].to_numpy(bool)
                own, asked = rows[~is_query], rows[is_query]
                if len(own):
                    held.append((_matrix(own["vector"], width), own["id"].to_numpy(np.int64)))
                if len(asked) and tree is None:
                    tree = BallTree(*(np.concatenate(x) for x in zip(*held)), leaf_rows)
                    held = []
                for start in range(0, len(asked), block_rows):
                    block = asked.iloc[start : start + block_rows]
                    ids = block["id"].to_numpy(np.int64)
                    least = block["least"].to_numpy(float)
                    best = search_shard(tree, _matrix(block["vector"], width), ids, least, k)
                    yield pd.DataFrame(
                        {"query_id": ids[best.query], "vec_id": best.id, "score": best.score}
                    )

    return run


class Search:
    """The stored shards of ``vectors`` (id, vector), and searches in them."""

    def __init__(
        self,
        vectors: DataFrame,
        k: int,
        scratch: Scratch,
        shard_rows: int = SHARD_ROWS,
        block_rows: int = BLOCK_ROWS,
        leaf_rows: int = LEAF_ROWS,
        pivots: int = PIVOTS,
    ):
        ship_package(vectors.sparkSession)
        self.k, self.scratch = k, scratch
        stored = scratch.stage(vectors, "vectors")
        total, width = stored.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
        width = width or 0
        # No more cells than full shards: a query crosses to each that it may need.
        wanted = min(pivots, max(1, math.ceil(total / shard_rows)))
        picked = stored.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(wanted)
        points = picked.toPandas()["vector"]  # ``pivots`` rows at most
        self.cells = Cells(np.unique(_matrix(points, width), axis=0), shard_rows)
        near = scratch.stage(
            stored.mapInPandas(
                _dealt(self.cells), "id long, vector array<double>, cell int, distance double"
            ),
            "cells",
        )
        sizes = near.groupBy("cell").agg(F.count(F.lit(1)), F.max("distance"))
        self.cells.measure({cell: (rows, far) for cell, rows, far in sizes.collect()})
        spark = vectors.sparkSession
        first = [(i, int(n), int(self.cells.first[i])) for i, n in enumerate(self.cells.shards)]
        bounded = spark.createDataFrame(first, "cell int, n long, first long")
        own = F.col("first") + F.pmod(F.xxhash64("id"), F.col("n"))
        self.shards = near.join(F.broadcast(bounded), "cell").select(
            "id", "vector", own.alias("shard")
        )
        self._run = _searched(k, leaf_rows, block_rows, width)

    def at_home(self, queries: DataFrame) -> DataFrame:
        """(id, vector, shard, least) of ``queries`` (id, vector): the first shard."""
        salted = queries.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)))
        return salted.mapInPandas(_at_home(self.cells, self.k), self._asked)

    def elsewhere(self, home: DataFrame, first: DataFrame) -> DataFrame:
        """The other pairs of query and shard that the first results leave open."""
        kth = (
            first.groupBy("query_id")
            .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
            .where(F.col("n") >= self.k)
            .select(F.col("query_id").alias("id"), "low")
        )
        bounded = home.join(kth, "id", "left").select(
            "id", "vector", "shard", F.coalesce("low", F.lit(-math.inf)).alias("least")
        )
        return bounded.mapInPandas(_elsewhere(self.cells), self._asked)

    def search(self, asked: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): up to k of its shard for each row of ``asked``."""
        none = F.lit(None).cast("double")
        own = self.shards.select("shard", F.lit(False).alias("is_query"), "id", "vector", none.alias("least"))
        rows = own.unionByName(asked.withColumn("is_query", F.lit(True)))
        tasks = min(max(1, int(self.cells.first[-1])), MOST_TASKS)
        streams = rows.repartition(tasks, "shard").sortWithinPartitions("shard", "is_query")
        return streams.mapInPandas(self._run, "query_id long, vec_id long, score double")

    _asked = "id long, vector array<double>, shard long, least double"


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scratch: Scratch | None = None,
    **sizes: int,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``vectors`` (id, vector).

    Queries are the rows for which ``is_query`` holds; a candidate is every row
    but the query's own. ``sizes`` are those of ``Search``.
    """
    scratch = scratch_for(vectors.sparkSession, scratch)
    index = Search(vectors, k, scratch, **sizes)
    queries = index.shards.where(is_query).select("id", "vector")
    home = scratch.stage(index.at_home(queries), "home")
    first = scratch.stage(index.search(home), "first-shard")
    found = first.unionByName(index.search(index.elsewhere(home, first)))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
