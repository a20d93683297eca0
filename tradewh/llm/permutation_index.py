"""Approximate nearest neighbours by a permutation index.

Every vector is represented by its ``prefix`` nearest pivots, nearest first, and
belongs to the cell of the nearest of the first pivots (as many as make cells of
about ``CELL`` rows). A query goes to its nearest cells only. How many are needed
is measured first: ``ASKED`` queries at most are compared with all rows, exactly,
and the least number of cells is taken that holds ``TARGET`` of their neighbours
(queries of one cell count as one, so a group of copies doesn't speak for the
rest). So the work is below rows times queries as far as the vectors allow it:
clustered ones need a few cells, those without any structure most of them.

In a cell, rows are posted in one inverted file per pivot with the pivot's place
in their order. A query adds up, over the files of its own pivots, the footrule
distance between the two orders (a pivot missing from one counts as last); the
nearest ``share`` of the cell by that distance is ranked again by the inner
product of the original vectors, with all rows within ``SLACK`` of the last one's
distance, so that near copies, whose orders differ by chance, come in together or
not at all. Orders tell directions only: where lengths differ, rows are ranked by
their length times the cosine that their distance stands for, which is read off
a sample of the cell (``Cosines``). With equal lengths that is the distance's rank.
The nearest cell is searched first; of the others, only rows that reach its k-th
score leave the task. A window per query merges them.

A task holds one cell, or a part of ``SHARD`` values of a large one, and one block
of its queries (``BLOCK`` values), so its memory doesn't grow with either table.
Pivots are ``PIVOTS`` of a bounded sample of distinct vectors (the first in the
order of a hash of the vector), picked farthest first: groups of copies or near
copies take no more than a place or two among them.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id or of another length than
most vectors have; a repeated id counts once (its smallest vector); fewer
candidates than asked for are all returned; like scores are ordered by the
smaller id; no rows, no results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewh.operators.materialize import materialize

PIVOTS = 256
PREFIX = 64
SHARE = 0.2
#: Near ties, as a part of the largest nearness two orders can have.
SLACK = 0.02
#: Distinct vectors a pivot is picked from.
SAMPLE = 4
#: Rows of a cell, about.
CELL = 2048
#: Queries that are compared with all rows, and the part of their neighbours that the cells visited hold.
ASKED = 256
TARGET = 0.98
#: Values (rows times their length) of rows and of queries in a task.
SHARD = 1 << 20
BLOCK = 1 << 19


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v) rows that take part, v in double precision."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first (largest cosine)."""
    near = (x @ pivots.T) / np.linalg.norm(pivots, axis=1)
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


def spread_out(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows at most, each the one farthest (smallest cosine) from those before; none twice by direction."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    taken, near = [0], unit @ unit[0]
    while len(taken) < min(n, len(sample)) and near.min() < 1 - 1e-9:
        taken.append(int(np.argmin(near)))
        near = np.maximum(near, unit @ unit[taken[-1]])
    return sample[taken]


class InvertedFiles:
    """For each pivot a file with the places it has in the rows' orders, counted from the end (0: not among them)."""

    def __init__(self, perm: np.ndarray, n_pivots: int):
        self.n, self.prefix = perm.shape
        kind = np.uint16 if self.prefix <= 256 else np.uint32
        self.left = np.arange(self.prefix, 0, -1, kind)
        # Parts of the rows, so that the files a query walks stay in the processor's cache.
        self.files = []
        for part in np.split(perm, range(2048, self.n, 2048)):
            self.files.append(np.zeros((n_pivots, len(part)), kind))
            self.files[-1][part, np.arange(len(part))[:, None]] = self.left

    def nearness(self, order: np.ndarray) -> np.ndarray:
        """A constant less half the footrule distance of each row to the order.

        With a missing pivot at place ``prefix``, the distance is a constant less
        2 (prefix - max(a, b)) for every pivot that both have, at places a and b.
        """
        most = self.left[:, None]
        return np.concatenate([np.minimum(files[order], most).sum(0, dtype=most.dtype) for files in self.files]).astype(np.int64)


class Cosines:
    """The mean cosine that a nearness stands for: a rising curve through the
    means of equal parts of a sample of pairs."""

    def __init__(self, files: InvertedFiles, x: np.ndarray, queries: np.ndarray, q_orders: np.ndarray,
                 rows: int = 512, asked: int = 48, parts: int = 64):
        some = np.unique(np.linspace(0, len(x) - 1, rows).astype(np.int64))
        ask = np.unique(np.linspace(0, len(queries) - 1, asked).astype(np.int64))
        near = np.concatenate([files.nearness(q_orders[a])[some] for a in ask])
        unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
        cosine = (unit(queries[ask]) @ unit(x[some]).T).ravel()
        order = np.argsort(near, kind="stable")
        groups = np.array_split(order, min(parts, len(order)))
        at = np.array([near[g].mean() for g in groups])
        mean = np.maximum.accumulate([cosine[g].mean() for g in groups])
        most = files.prefix * (files.prefix + 1) // 2
        # By nearness, which is a whole number; the slope keeps it rising.
        self.of = np.interp(np.arange(most + 1), at, mean) + 1e-6 * np.arange(most + 1) / most


def search_shard(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray,
                 k: int, prefix: int, share: float, floors: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """(query, id, score) of the best k in one shard for each query, of those that reach its floor."""
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    files = InvertedFiles(orders(x, pivots, prefix), len(pivots))
    keep = min(len(ids), max(2 * k, int(np.ceil(share * len(ids)))))
    slack = int(SLACK * prefix * (prefix + 1) / 2)
    q_orders, length = orders(queries, pivots, prefix), np.linalg.norm(x, axis=1)
    cosines = Cosines(files, x, queries, q_orders).of
    out = []
    floors = np.full(len(queries), -np.inf) if floors is None else floors
    for qid, q, perm, floor in zip(query_ids.tolist(), queries, q_orders, floors.tolist()):
        near = files.nearness(perm)
        own = np.searchsorted(ids, qid)
        guess = cosines[near] * length
        upper = cosines[np.minimum(near + slack, len(cosines) - 1)] * length
        if own < len(ids) and ids[own] == qid:
            guess[own] = upper[own] = -np.inf
        least = np.partition(guess, len(guess) - keep)[len(guess) - keep]
        some = np.flatnonzero((upper >= least) & (upper > -np.inf))
        score = x[some] @ q
        some, score = some[score >= floor], score[score >= floor]
        if len(some) > k:  # all that tie with the k-th stay, for the ids to decide
            best = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
            some, score = some[best], score[best]
        for i in np.lexsort((ids[some], -score))[:k].tolist():
            out.append((qid, int(ids[some[i]]), float(score[i])))
    return out


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def cells_needed(placed: DataFrame, queries: DataFrame, near_cells: Callable[[np.ndarray, int], np.ndarray], n_cells: int, k: int,
                 asked: int, target: float) -> int:
    """The least number of nearest cells that hold ``target`` of the true k
    neighbours of some queries (those of the smallest hashes, ``asked`` at most)."""
    some = queries.orderBy(F.xxhash64("v", "id"), "id").limit(asked).collect()
    if not some:
        return 1
    shared = placed.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in some]), np.array([r["v"] for r in some], np.float64)))

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        score, cell = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int32)
        for rows in batches:
            if len(rows):
                new = q @ _matrix(rows["v"]).T
                new[ids[:, None] == rows["id"].to_numpy()] = -np.inf
                score = np.hstack([score, new])
                cell = np.hstack([cell, np.broadcast_to(rows["cell"].to_numpy(), new.shape)])
                best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, cell = np.take_along_axis(score, best, 1), np.take_along_axis(cell, best, 1)
        query, _ = at = np.nonzero(score > -np.inf)
        yield pd.DataFrame({"query": query, "score": score[at], "cell": cell[at]})

    found = placed.mapInPandas(exact, "query int, score double, cell int")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "cell")
    # At most asked x k rows.
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("query", "cell").toPandas()
    order = near_cells(shared.value[1], n_cells)
    depth = np.argsort(order, axis=1)[found["query"], found["cell"]]
    weight = 1 / np.bincount(order[:, 0], minlength=n_cells)[order[found["query"], 0]]
    reached = np.cumsum(np.bincount(depth, weight, n_cells))
    return int(np.argmax(reached >= target * reached[-1])) + 1 if len(found) else 1


def nearest(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", n_pivots: int = PIVOTS,
            prefix: int = PREFIX, share: float = SHARE, shard: int = SHARD, block: int = BLOCK, cell: int = CELL, asked: int = ASKED,
            target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query.

    ``is_query`` is a condition on ``id``; candidates are all vectors but the query's own.
    """
    rows = materialize(valid_vectors(table, id_col, vec_col), "vectors")
    schema = "query_id long, vec_id long, score double"
    ranked = "query_id long, rank int, vec_id long, score double"
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if dims is None:
        return table.sparkSession.createDataFrame([], ranked)
    rows = rows.where(F.size("v") == dims["d"])
    # A bounded number of distinct vectors, whatever the table holds: those of
    # the smallest hashes, looked for among some twice as many.
    place, most = F.pmod(F.xxhash64("v"), F.lit(1 << 32)), SAMPLE * n_pivots
    distinct = rows.agg(F.approx_count_distinct(F.xxhash64("v"))).first()[0]
    likely = place <= int((1 << 32) * min(1.0, 2 * most / max(1, distinct)))
    sample = rows.where(likely).select("v").distinct().orderBy(place, "v").limit(most).collect()
    pivots = spread_out(np.array([r["v"] for r in sample], np.float64), n_pivots)
    prefix = min(prefix, len(pivots))
    spark, width = table.sparkSession, dims["d"]
    shared = spark.sparkContext.broadcast(pivots)
    n_cells = max(1, min(len(pivots), dims["n"] // cell))

    def near_cells(x: np.ndarray, n: int) -> np.ndarray:
        return orders(x, shared.value[:n_cells], n)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                yield rows.assign(cell=near_cells(_matrix(rows["v"]), 1)[:, 0])

    placed = materialize(rows.mapInPandas(place, "id long, v array<double>, cell int"), "placed")
    queries = placed.where(is_query).select("id", "v")
    visit = 1 if n_cells == 1 else cells_needed(placed, queries, near_cells, n_cells, k, asked, target)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                yield rows.assign(cells=list(near_cells(_matrix(rows["v"]), visit)))

    routed = materialize(queries.mapInPandas(route, "id long, v array<double>, cells array<int>"), "routed")

    def run(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = search_shard(vectors["id"].to_numpy(), _matrix(vectors["v"]), asked["id"].to_numpy(), _matrix(asked["v"]), shared.value,
                             k, prefix, share, asked["floor"].to_numpy())
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def search(sent: DataFrame) -> DataFrame:
        """Each (id, v, floor, cell) against the rows of its cell."""
        # A row per cell, so at most ``n_pivots``: parts of the cell's rows, and blocks of the queries sent to it.
        parts = F.greatest(F.lit(1), F.ceil(F.col("n") * width / shard)).cast("int")
        blocks = F.greatest(F.lit(1), F.ceil(F.col("asked") * width / block)).cast("int")
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).join(sent.groupBy("cell").agg(F.count(F.lit(1)).alias("asked")), "cell")
        sizes = F.broadcast(materialize(sizes.select("cell", parts.alias("parts"), blocks.alias("blocks")), "cells"))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = placed.join(sizes, "cell").select("id", "v", "cell", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("s"), each("blocks").alias("b"))
        right = sent.join(sizes, "cell").select(
            "id", "v", "floor", "cell", each("parts").alias("s"), F.pmod(F.xxhash64("id", F.lit(1)), "blocks").cast("int").alias("b"))
        return left.groupBy("cell", "s", "b").cogroup(right.groupBy("cell", "s", "b")).applyInPandas(run, schema)

    # The nearest cell first: rows of the others count if they reach its k-th score.
    everything = F.lit(float("-inf"))
    first = materialize(search(routed.select("id", "v", everything.alias("floor"), F.col("cells")[0].alias("cell"))), "first")
    found = first
    if visit > 1:
        place = Window.partitionBy("query_id").orderBy(F.desc("score"))
        floors = first.withColumn("n", F.row_number().over(place)).where(F.col("n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        others = routed.join(floors, "id", "left").select("id", "v", F.coalesce("floor", everything).alias("floor"),
                                                          F.explode(F.slice("cells", 2, visit - 1)).alias("cell"))
        found = first.unionByName(search(others))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
