"""Exact top-k search (operator 7): KD-trees per shard.

Vectors become integers floor(256 * x). They are spread over shards by hash; each shard
builds a KD-tree by median splits, with a tight bounding box at each node. The inner product
of a query q with any vector in a box is at most sum(max(q*low, q*high)), so a query walks a
tree best node first and stops where the bound falls under its k-th best score.

Each query first searches its home shard; the k-th score found there goes with it to all
other shards (blocks of queries against shards), which then skip most nodes, if the data
allow. Shards return at most k rows a query, merged by a ranked window.

Defined results: vectors that are null, empty, or hold null or non-finite components take no
part, nor do vectors whose integers have a squared length of 2^63 or more (a score could then
exceed a long; below it none can); scores of vectors of different lengths don't exist; equal scores go to the smaller
vec_id; a row with the query's id is never its result; rows that repeat an id and a vector
count once; with fewer than k candidates all are returned; null ids take no part; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Staged, bucket_of, group_count
from .embeddings import integer_vectors

SHARD = 2_048
QUERY_BLOCK = 2_048
LEAF = 64


def to_integers(vecs: list[bytes]) -> np.ndarray:
    """Rows of integers as integral doubles, or as exact integers where doubles can't hold the sums."""
    x = np.stack([np.frombuffer(v, "<i8") for v in vecs])
    if x.shape[1] * float(np.abs(x).max(initial=0)) ** 2 < 2**53:
        return x.astype(np.float64)
    return np.array([[int(c) for c in r] for r in x], dtype=object)


class KDTree:
    """Median splits along the widest side; node boxes are tight."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids = points, ids
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.parts: list[tuple[int, int] | np.ndarray] = []  # children, or rows of a leaf
        if len(points):
            self._grow(np.arange(len(points)), leaf)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        own = self.points[rows]
        low, high = own.min(axis=0), own.max(axis=0)
        node = len(self.parts)
        self.low.append(low)
        self.high.append(high)
        self.parts.append(rows)
        side = int(np.argmax(high - low))
        if len(rows) > leaf and high[side] > low[side]:
            order = rows[np.argsort(own[:, side], kind="stable")]
            half = len(order) // 2
            self.parts[node] = (self._grow(order[:half], leaf), self._grow(order[half:], leaf))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest inner product that each node's box allows, by query."""
        low, high = np.array(self.low), np.array(self.high)
        return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T

    def search(self, query: np.ndarray, bound: np.ndarray, own_id: int, k: int, least) -> list[tuple[int, int]]:
        """Up to k (score, -vec_id) of the best, those under ``least`` left out."""
        best: list[tuple[int, int]] = []  # a heap, the worst first
        nodes = [(-bound[0], 0)]
        while nodes:
            top, node = heapq.heappop(nodes)
            floor = best[0][0] if len(best) == k else least
            if floor is not None and -top < floor:
                break
            part = self.parts[node]
            if isinstance(part, tuple):
                for child in part:
                    if floor is None or bound[child] >= floor:
                        heapq.heappush(nodes, (-bound[child], child))
                continue
            score = self.points[part] @ query
            some = np.arange(len(part)) if floor is None else np.flatnonzero(score >= floor)
            if len(some) > 4 * k and score.dtype != object:  # only the k best of a leaf can matter
                some = some[np.lexsort((self.ids[part[some]], -score[some]))[: k + 1]]
            for s, i in zip(score[some].tolist(), self.ids[part[some]].tolist(), strict=True):
                if i == own_id:
                    continue
                item = (int(s), -i)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return sorted(best, reverse=True)


def _by_length(vecs: pd.Series) -> dict[int, np.ndarray]:
    size = vecs.map(len).to_numpy()
    return {int(n): np.flatnonzero(size == n) for n in np.unique(size)}


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` (vec_id, embedding) the k best of ``vectors``."""
    staged = Staged(vectors.sparkSession)
    usable = lambda t: integer_vectors(t.withColumn("vec_id", F.col("vec_id").cast("long")), ("vec_id",)).where("vec_id is not null and vec is not null").distinct()
    data = staged.write(usable(vectors))
    asked = staged.write(usable(queries))
    shards = group_count(data.count(), shard, 1)
    blocks = group_count(asked.count(), query_block, 1)
    data = data.withColumn("shard", bucket_of("vec_id", shards))
    asked = asked.withColumn("home", bucket_of("vec_id", shards)).withColumn("block", bucket_of("vec_id", blocks, 1))

    def searched(points: pd.DataFrame, ask: pd.DataFrame) -> list[tuple[int, int, int, int]]:
        out: list[tuple[int, int, int, int]] = []
        if not len(points) or not len(ask):
            return out
        has, wants = _by_length(points["vec"]), _by_length(ask["vec"])
        for n, rows in wants.items():
            if n not in has:
                continue
            part, some = points.iloc[has[n]], ask.iloc[rows]
            numbers = to_integers([*part["vec"], *some["vec"]])
            tree = KDTree(numbers[: len(part)], part["vec_id"].to_numpy())
            own = numbers[len(part) :]
            bounds = tree.bounds(own)
            for q, b, i, least in zip(own, bounds, some["vec_id"].tolist(), some["least"].tolist(), strict=True):
                found = tree.search(q, b, i, k, int(least) if least else None)
                out += [(i, n, -minus, score) for score, minus in found]
        return out

    columns = ["query_id", "bytes", "vec_id", "score"]
    schema = "query_id long, bytes long, vec_id long, score long"

    def at_home(points: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(searched(points, ask.assign(least=None)), columns=columns)

    home = staged.write(data.groupBy("shard").cogroup(asked.groupBy("home")).applyInPandas(at_home, schema))
    # The k-th score at home; a query with fewer than k there has none.
    kth = home.groupBy("query_id", "bytes").agg(F.count("*").alias("n"), F.min("score").alias("s")).select(
        F.col("query_id").alias("vec_id"), F.col("bytes").alias("n_bytes"), F.when(F.col("n") == k, F.col("s").cast("string")).alias("least")
    )
    sent = asked.withColumn("n_bytes", F.length("vec").cast("long")).join(kth, ["vec_id", "n_bytes"], "left")
    sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    spread = data.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def elsewhere(points: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(searched(points, ask), columns=columns)

    away = spread.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInPandas(elsewhere, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        home.unionByName(away)
        .select("query_id", "vec_id", "score")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
