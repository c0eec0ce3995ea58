"""Hard-negative mining (operator 13): a secondary-sort shuffle of packed pair scores.

Vectors become integers floor(256 * x). Anchors meet all rows in blocks (a stated query set
against all rows). A pair's score is packed into one binary key, so that bytewise order is
anchor, descending score, same label first, ascending id; ``repartitionAndSortWithinPartitions``
deals the keys by anchor and sorts them, spilling to disk. A task then reads one sorted stream:
the first same-label keys of an anchor open its positive windows, the different-label keys that
follow go to each open window they fit, and rows leave at once; no anchor is ever held whole.

What a block sends is pre-aggregated without loss. A first pass over same-label rows finds each
anchor's best scores; a block then sends its own best positives and, for each window, its own
best negatives, since no other row of the block can be among the first ones overall.

Defined results: rows with a null id, label or vector, an empty vector, or any null or non-finite
component take no part; nor do vectors whose integers have a squared length of 2^63 or more (a
score could then exceed a long; below it none can); vectors of different lengths don't meet;
rows that repeat an id, a label and a vector count once, and rows that repeat an anchor's id
with another label or vector are anchors of their own; a row with the anchor's id is never its
result; equal scores go to the smaller id; a positive score under zero has no negatives, as no
score lies in its window, and one of zero takes those of zero; fewer rows than asked for are all
returned; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Staged, bucket_of, group_count
from .embeddings import integer_vectors

ROW_BLOCK = 8_192
ANCHOR_BLOCK = 1_024
#: Anchors whose scores against a block of rows are held at once.
CHUNK = 128
#: Keys a sorted partition should hold.
KEYS = 500_000
_KEY = np.dtype([("anchor", ">u8"), ("version", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_UNPACK = struct.Struct(">QQQBQ")
_HALF = 1 << 63


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows: in doubles where they hold every sum, else in longs
    (whose partial sums may wrap around, but not the results, see the bound on lengths)."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if a.shape[1] * most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def first_ones(score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores in order, ties to the earlier position."""
    if len(score) > 4 * k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.argsort(-score[some], kind="stable")][:k]


def in_windows(score: np.ndarray, tops: list[int], k: int, low: int, high: int) -> np.ndarray:
    """Positions of the first k scores of each window low*top <= 100*score <= high*top, once each."""
    order = np.argsort(-score, kind="stable")
    falling = -score[order]  # ascending
    found: set[int] = set()
    for top in set(tops):
        least, most = -(-low * top // 100), high * top // 100
        if least <= most:
            a, z = np.searchsorted(falling, -most, "left"), np.searchsorted(falling, -least, "right")
            found.update(order[a : min(z, a + k)].tolist())
    return np.array(sorted(found), dtype=np.int64)


def _alike(rows: pd.DataFrame, ask: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, pd.DataFrame, np.ndarray]]:
    """Rows (by ascending id) and anchors of equal vector length, with their integers, some anchors at a time."""
    rows = rows.sort_values("vec_id", kind="stable")
    has, wants = rows["vec"].map(len), ask["vec"].map(len)
    for n in sorted(set(has) & set(wants)):
        some, asked = rows[has == n], ask[wants == n]
        block = np.stack([np.frombuffer(v, "<i8") for v in some["vec"]])
        for at in range(0, len(asked), CHUNK):
            part = asked.iloc[at : at + CHUNK]
            yield some, block, part, np.stack([np.frombuffer(v, "<i8") for v in part["vec"]])


def pack(anchor: np.ndarray, version: np.ndarray, score: np.ndarray, other: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """Keys whose bytes sort by anchor, descending score, same label first, ascending id."""
    keys = np.zeros(len(ids), dtype=_KEY)
    flip = lambda x: x.astype(np.int64).view(np.uint64) ^ np.uint64(_HALF)
    keys["anchor"], keys["version"], keys["id"] = flip(anchor), flip(version), flip(ids)
    keys["score"], keys["kind"] = ~flip(score), other
    raw = keys.tobytes()
    return [raw[i : i + _KEY.itemsize] for i in range(0, len(raw), _KEY.itemsize)]


def unpack(key: bytes) -> tuple[int, int, int, int, int]:
    """(anchor, version, score, other label, id) of a key."""
    anchor, version, score, other, own = _UNPACK.unpack(key)
    return anchor - _HALF, version - _HALF, _HALF - 1 - score, other, own - _HALF


def stream(keys: Iterator[bytes], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of one sorted stream: at most ``positives`` open windows are held."""
    now, windows = None, []
    for key in keys:
        anchor, version, score, other, own = unpack(key)
        if (anchor, version) != now:
            now, windows = (anchor, version), []
        if not other:
            if len(windows) < positives:
                windows.append([own, score, 0])
            continue
        for window in windows:
            if window[2] < negatives and low * window[1] <= 100 * score <= high * window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], own, window[1], score


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of (vec_id, label, embedding):
    for each anchor (rows where ``is_anchor`` holds) and each of its first ``positives`` same-label rows the first
    ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score."""
    staged = Staged(vectors.sparkSession)
    spark = staged.spark
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.coalesce(is_anchor, F.lit(False)).alias("anchor"), "embedding")
    table = table.where("vec_id is not null and label is not null and embedding is not null")
    rows = staged.write(integer_vectors(table, ("vec_id", "label", "anchor")).where("vec is not null").distinct().withColumn("version", F.xxhash64("label", "vec")))
    asked = rows.where("anchor").drop("anchor")
    n, n_asked = rows.count(), asked.count()
    i_blocks, j_blocks = group_count(n, row_block, 1), group_count(n_asked, anchor_block, 1)
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    spread = rows.drop("anchor").withColumn("i", bucket_of("vec_id", i_blocks)).withColumn("j", every(j_blocks))

    def against_blocks(anchors: DataFrame, fn, schema: str) -> DataFrame:
        sent = anchors.withColumn("j", bucket_of("vec_id", j_blocks, 1)).withColumn("i", every(i_blocks))
        return spread.groupBy("i", "j").cogroup(sent.groupBy("i", "j")).applyInPandas(fn, schema)

    def best_of_label(rows: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        for some, block, part, wanted in _alike(rows, ask):
            label, ids = some["label"].to_numpy(), some["vec_id"].to_numpy()
            for value, at in part.reset_index(drop=True).groupby("label").groups.items():
                mine = np.flatnonzero(label == value)
                scores = products(wanted[at], block[mine])
                for anchor, version, score in zip(part["vec_id"].to_numpy()[at], part["version"].to_numpy()[at], scores, strict=True):
                    others = np.flatnonzero(ids[mine] != anchor)
                    best = others[first_ones(score[others], positives)]
                    out += [(anchor, version, s, o) for s, o in zip(score[best].tolist(), ids[mine][best].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["vec_id", "version", "score", "other"])

    found = against_blocks(asked, best_of_label, "vec_id long, version long, score long, other long")
    order = Window.partitionBy("vec_id", "version").orderBy(F.desc("score"), "other")
    tops = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= positives).groupBy("vec_id", "version").agg(F.collect_list("score").alias("tops"))
    # An anchor without a positive has no rows.
    asked = staged.write(asked.join(tops, ["vec_id", "version"]))

    def packed(rows: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        keys: list[bytes] = []
        for some, block, part, wanted in _alike(rows, ask):
            label, ids = some["label"].to_numpy(), some["vec_id"].to_numpy()
            scores = products(wanted, block)
            for anchor, version, own, best, score in zip(part["vec_id"], part["version"], part["label"], part["tops"], scores, strict=True):
                same, others = np.flatnonzero((label == own) & (ids != anchor)), np.flatnonzero((label != own) & (ids != anchor))
                same = same[first_ones(score[same], positives)]
                same = same[score[same] >= min(best)]
                others = others[in_windows(score[others], [int(t) for t in best], negatives, low, high)]
                pick = np.concatenate([same, others])
                kind = np.repeat([0, 1], [len(same), len(others)])
                keys += pack(np.full(len(pick), anchor), np.full(len(pick), version), score[pick], kind, ids[pick])
        return pd.DataFrame({"key": keys})

    pairs = against_blocks(asked, packed, "key binary").rdd.map(lambda row: (bytes(row[0]), None))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), group_count(n_asked * i_blocks * positives * (negatives + 1), KEYS, 1))
    dealt = pairs.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:16]))
    mined = dealt.mapPartitions(lambda part: stream((key for key, _ in part), positives, negatives, low, high))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(mined, schema, verifySchema=False)
