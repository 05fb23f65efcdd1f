"""Approximate nearest neighbours by collision counting.

Vectors are projected on orthonormal directions; each projection of a block of
vectors is a sorted array. A query opens a window around its own place in every
array, and virtual rehashing widens all windows together, level by level. A vector
collides with the query in an array if its rank there lies in the window; those
that collide in ``collisions`` of all arrays or more are candidates. Widening stops
when ``share`` of the block are candidates (and more than enough to fill the
answer), or when the windows hold the block. Candidates are verified with their
exact inner product in double precision.

Inner products become distances by one more coordinate: vectors are filled up to the
largest length and queries scaled to it, so near and similar agree.

Every row is indexed, in blocks of bounded size dealt out by row; a stated set of
queries meets every block, in blocks of its own. Answers of blocks are merged in two
steps. Recall against brute force is measured in the tests.

Defined results: vectors that are null, zero or hold null or non-finite components
take no part, on either side; vectors of different sizes never meet; a repeated row is a row of
its own, so it is a neighbour of its copy; ties go to the smaller id, null ids
last; fewer candidates than ``k`` are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import staged, table

ARRAYS = 64
LEVELS = np.append(0.1 * 1.3 ** np.arange(17), np.inf)  # half widths, in spreads of a projection


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, vectors: np.ndarray, longest: float, collisions: float, share: float) -> None:
        self.vectors, self.longest, self.share = vectors, longest, share
        size = vectors.shape[1] + 1
        self.arrays = min(size, ARRAYS)
        directions = np.linalg.qr(np.random.default_rng(size).normal(size=(size, size)))[0]
        self.directions = directions[:, : self.arrays]
        squares = (vectors * vectors).sum(axis=1)
        filled = np.sqrt(np.maximum(longest**2 - squares, 0))
        projected = np.concatenate([vectors, filled[:, None]], axis=1) @ self.directions
        order = projected.argsort(axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=0).T.copy()
        ranks = np.empty((self.arrays, len(vectors)), dtype=np.int32)
        np.put_along_axis(ranks, order.T, np.arange(len(vectors), dtype=np.int32)[None, :], axis=1)
        self.ranks = ranks.astype(np.uint16 if len(vectors) < 1 << 16 else np.uint32)
        self.thinned = np.ascontiguousarray(self.ranks[:, :: max(1, len(vectors) // 256)])
        self.threshold = math.ceil(collisions * self.arrays)

    def windows(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First rank and width of the window by query, level and array."""
        lengths = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        places = (queries / lengths * self.longest) @ self.directions[:-1]
        spread = float(self.sorted.std()) or 1.0
        first = np.empty((len(queries), len(LEVELS), self.arrays), dtype=self.ranks.dtype)
        width = np.empty_like(first)
        for k, ordered in enumerate(self.sorted):
            low = np.searchsorted(ordered, places[:, k, None] - LEVELS * spread, side="left")
            high = np.searchsorted(ordered, places[:, k, None] + LEVELS * spread, side="right")
            first[:, :, k], width[:, :, k] = low, high - low
        return first, width

    def _colliding(self, ranks: np.ndarray, first: np.ndarray, width: np.ndarray) -> np.ndarray:
        # Unsigned: ranks below the window wrap round and are too large.
        inside = (ranks - first[:, None]) < width[:, None]
        return np.add.reduce(inside, axis=0, dtype=np.uint16) >= self.threshold

    def candidates(self, first: np.ndarray, width: np.ndarray, least: int) -> np.ndarray:
        """Rows that collide often enough at the first level that has ``least`` of them."""
        wanted = least / self.ranks.shape[1]
        low, high = 0, len(LEVELS) - 1
        while low < high:  # a guess from a part of the block, where to begin
            level = (low + high) // 2
            if self._colliding(self.thinned, first[level], width[level]).mean() >= wanted:
                high = level
            else:
                low = level + 1
        for level in range(low, len(LEVELS)):
            found = np.flatnonzero(self._colliding(self.ranks, first[level], width[level]))
            if len(found) >= least:
                return found
        return np.arange(self.ranks.shape[1])

    def nearest(self, queries: np.ndarray, own: np.ndarray, rows: np.ndarray, order: tuple, k: int):
        """For each query the positions and scores of its ``k`` nearest in the block."""
        least = min(len(rows), max(k + 1, math.ceil(self.share * len(rows))))
        unnamed, ids = order
        for start in range(0, len(queries), 64):
            part = slice(start, start + 64)
            first, width = self.windows(queries[part])
            for n, query in enumerate(queries[part]):
                found = self.candidates(first[n], width[n], least)
                found = found[rows[found] != own[start + n]]
                scores = (self.vectors[found] * query).sum(axis=1)
                if len(found) > k:
                    worst = np.partition(scores, len(scores) - k)[len(scores) - k]
                    found, scores = found[scores >= worst], scores[scores >= worst]
                best = np.lexsort((ids[found], unnamed[found], -scores))[:k]
                yield found[best], scores[best]


def _merged(parts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` of several answers, nearest first, ties to the smaller id."""
    ordered = F.array_sort(
        F.flatten(F.collect_list("found")),
        lambda a, b: F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1))
        .when(a["vec_id"].eqNullSafe(b["vec_id"]), 0)
        .when(b["vec_id"].isNull() | (a["vec_id"] < b["vec_id"]), -1)
        .otherwise(1),
    )
    return parts.groupBy(*keys).agg(F.slice(ordered, 1, k).alias("found"))


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 20,
    collisions: float = 0.8,
    share: float = 0.1,
    block_rows: int = 2048,
    block_queries: int = 1024,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest rows of each query row,
    by largest inner product, the query's own row left out."""
    rows = vectors.select(
        F.coalesce(F.col(vec_id).cast("long"), F.lit(0)).alias("vec_id"),
        F.col(vec_id).isNotNull().alias("named"),
        F.col(embedding).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.filter(usable(F.col("v"))).withColumn("row", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("size", F.size("v")), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    sizes = rows.groupBy("size").agg(
        F.count("*").alias("n"), F.count_if("asks").alias("n_asking"), F.max(norm).alias("longest")
    )
    sizes = sizes.select(
        "size",
        "longest",
        F.greatest(F.ceil(F.col("n") / block_rows), F.lit(1)).alias("blocks"),
        F.greatest(F.ceil(F.col("n_asking") / block_queries), F.lit(1)).alias("query_blocks"),
    )
    dealt = rows.join(sizes, "size")
    spread = F.xxhash64("row")
    block, query_block = F.pmod(spread, "blocks"), F.pmod(spread, "query_blocks")
    all_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    all_query_blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1))
    indexed = dealt.select(
        "size", "longest", "vec_id", "named", "row", "v", block.alias("block"), all_query_blocks.alias("query_block")
    )
    asking = dealt.filter("asks").select(
        *(F.col(name).alias(name) for name in ("size", "vec_id", "named", "row", "v")),  # columns of its own
        query_block.alias("query_block"),
        all_blocks.alias("block"),
    )

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        answers = []
        if len(asked) and len(held):
            ids, named = held["vec_id"].to_numpy(), held["named"].to_numpy()
            built = Block(np.stack(held["v"].to_list()), float(held["longest"].iloc[0]), collisions, share)
            queries = np.stack(asked["v"].to_list())
            found = built.nearest(queries, asked["row"].to_numpy(), held["row"].to_numpy(), (~named, ids), k)
            block = int(held["block"].iloc[0])
            asking = zip(asked["row"], asked["vec_id"], asked["named"], found, strict=True)
            for row, query_id, query_named, (at, scores) in asking:
                pairs = [
                    {"vec_id": int(ids[n]) if named[n] else None, "score": float(s)}
                    for n, s in zip(at, scores, strict=True)
                ]
                answers.append((row, query_id, query_named, block, pairs))
        return pd.DataFrame(answers, columns=["row", "query_id", "named", "block", "found"])

    keys = ["size", "query_block", "block"]
    schema = "row long, query_id long, named boolean, block long, found array<struct<vec_id: long, score: double>>"
    answers = asking.groupBy(*keys).cogroup(indexed.groupBy(*keys)).applyInPandas(search, schema)
    answers = answers.withColumn("part", F.floor(F.col("block") / 64))
    answers = _merged(answers, ["row", "query_id", "named", "part"], k)
    answers = _merged(answers, ["row", "query_id", "named"], k)
    query_id = F.when(F.col("named"), F.col("query_id")).alias("query_id")
    return answers.select(query_id, F.posexplode("found").alias("nth", "near")).select(
        "query_id", (F.col("nth") + 1).alias("rank"), "near.vec_id", "near.score"
    )


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
