"""Best-fit packing (operator 10) into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest permitted length, and pieces are
spread over shards of about ``shard_items`` pieces by hash. A shard packs its pieces, long
ones first. A piece goes to the open bin with the least room that still holds it; if none
does, a bin is opened whose length is chosen by cost: for each permitted length the pieces
still waiting are laid into it greedily, and the length with the least cost a packed token
wins (cost = length + ``overhead``, the fixed cost of a sequence). At the end each bin
shrinks to the least permitted length that holds its contents.

Nothing is dropped, capped or shortened: pieces of a document cover it without overlap.
The average waste falls with the pieces in a shard, and a shard's work does not grow with
the input, which is why shards are packed apart.

Defined results: documents without tokens (null or empty text) need no space and come
back as one row with null bin; repeated rows are packed each, told apart by ``copy``; null
ids are packed like others; ties go to the piece of the smaller id; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.ranking import running_sums

from .common import Staged, group_count

#: Permitted sequence lengths, and the cost of a sequence besides its length, in tokens.
LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 16
SHARD_ITEMS = 4_000


def choose_length(first: int, waiting: Counter, sizes: list[int], lengths: tuple[int, ...], overhead: int) -> int:
    """The permitted length with the least cost a token, if a bin of it takes ``first``
    and then, greedily, the longest waiting pieces that fit. sizes: ascending."""
    best, best_cost = lengths[-1], float("inf")
    for length in lengths:
        if length < first:
            continue
        room = length - first
        taken: Counter = Counter()
        taken[first] += 1
        at = bisect.bisect_right(sizes, room)
        while at and room:
            size = sizes[at - 1]
            there = waiting[size] - taken[size]
            if there <= 0:
                at -= 1
                continue
            n = min(there, room // size)
            if not n:
                at = min(at - 1, bisect.bisect_right(sizes, room))
                continue
            taken[size] += n
            room -= n * size
            at = min(at - (n == there), bisect.bisect_right(sizes, room))
        cost = (length + overhead) / (length - room)
        if cost < best_cost:
            best, best_cost = length, cost
    return best


def best_fit(sizes: list[int], lengths: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], list[int]]:
    """Pack pieces given in falling size: bin and offset of each piece, length of each bin."""
    waiting = Counter(sizes)
    left = sorted(waiting)
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    used: list[int] = []
    of, offset = [], []
    for size in sizes:
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b = choose_length(size, waiting, left, lengths, overhead), len(used)
            used.append(0)
        waiting[size] -= 1
        if not waiting[size]:
            left.pop(bisect.bisect_left(left, size))
        of.append(b)
        offset.append(used[b])
        used[b] += size
        if room > size:
            bisect.insort(rooms, (room - size, b))
    final = [lengths[bisect.bisect_left(lengths, u)] for u in used]
    return of, offset, final


def pack(
    sizes: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD, shard_items: int = SHARD_ITEMS
) -> DataFrame:
    """Pack (doc_id, n_tokens) rows: doc_id, copy, piece, start, n_tokens, bin (shard-bin), capacity, offset.

    ``start`` is the piece's first token in its document, ``offset`` its place in the bin."""
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    staged = Staged(sizes.sparkSession)
    sizes = sizes.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("total"))
    # Rows are numbered by id and length: the same rows give the same bins, however they are dealt out.
    alike = sizes.groupBy("doc_id", "total").agg(F.count("*").alias("n"))
    upto = running_sums(alike, [], [F.asc_nulls_first("doc_id"), "total"], {"upto": F.col("n")}, stage=staged.write)
    alike = upto.withColumn("copy", F.explode(F.sequence(F.col("upto") - F.col("n"), F.col("upto") - 1)))
    sizes = staged.write(alike.select("doc_id", "total", "copy"))
    pieces = (
        sizes.where("total > 0")
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("total") / top) - 1)))
        .select("doc_id", "copy", "piece", (F.col("piece") * top).alias("start"), F.least(F.col("total") - F.col("piece") * top, F.lit(top)).alias("n_tokens"))
    )
    count = sizes.agg(F.sum(F.ceil(F.col("total") / top))).first()[0] or 0
    shards = group_count(count, shard_items, 1)
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True], kind="stable")
        of, offset, final = best_fit(pdf["n_tokens"].tolist(), lengths, overhead)
        shard = pdf["shard"].iloc[0]
        out = pdf[["doc_id", "copy", "piece", "start", "n_tokens"]].copy()
        out["bin"] = [f"{shard}-{b}" for b in of]
        out["capacity"] = np.array(final, dtype=np.int64)[of]
        out["offset"] = offset
        return out.astype({"doc_id": "Int64"})

    schema = "doc_id long, copy long, piece long, start long, n_tokens long, bin string, capacity long, offset long"
    packed = pieces.groupBy("shard").applyInPandas(run, schema)
    null = F.lit(None)
    empty = sizes.where("total <= 0").select(
        "doc_id", "copy", *[F.lit(0).cast("long").alias(c) for c in ("piece", "start", "n_tokens")],
        null.cast("string").alias("bin"), null.cast("long").alias("capacity"), null.cast("long").alias("offset"),
    )
    return packed.unionByName(empty)


def word_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): words between white space, the length that is packed here."""
    return docs.select("doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")).cast("long").alias("n_tokens"))


__all__ = ["LENGTHS", "OVERHEAD", "best_fit", "choose_length", "pack", "word_counts"]
