"""Embedding near-dedup (operator 1): quantised tile products with error bounds.

Vectors of one label are compared by cosine, all with all, in tiles. Vectors that are equal
in every component form a class first; one stands for it, with the class's size. A label's
representatives are spread over tiles of about ``TILE``; each pair of tiles is one group,
whose product of int8 codes is exact integer arithmetic (float32 products of ``EXACT`` dimensions
at a time, in which every partial sum is an integer under 2^24, added up in doubles). With u = s*q + d, |d| <= e, for unit vectors u the cosine
of two vectors differs from s*s'*(q.q') by at most e*|s'q'| + |sq|*e' + e*e', so pairs whose
upper bound stays under the threshold are done; only the others are computed in double
precision from the full vectors. A group returns each vector's number of links and one link
to the smallest vector of its linked set in the group, never the pairs themselves.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components,
and vectors with a null label, link with nothing; vectors of different lengths are not
compared; rows that repeat an id and a vector count once; a null vec_id links with nothing
and has a null component; ties and copies link with one another; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Staged, ship
from .components import components

TILE = 1_024
#: Dimensions whose products of codes, at most 127 * 127 each, float32 sums up exactly.
EXACT = 1_000
#: Candidate pairs that are recomputed at once.
CHUNK = 1 << 15


def valid_vectors(table: DataFrame, id_column: str = "vec_id", column: str = "embedding", keep: tuple[str, ...] = ("label",), zero: bool = True) -> DataFrame:
    """id, kept columns and vec: little-endian doubles, null for null, empty or non-finite
    vectors, and for zero vectors unless ``zero``."""
    ship(table.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(batch.num_columns - 1).to_pylist():
                v = np.array(x, dtype="<f8") if x else np.zeros(0)  # null components become nan
                out.append(v.tobytes() if len(v) and np.isfinite(v).all() and (zero or v.any()) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], names=[id_column, *keep, "vec"])

    schema = StructType([table.schema[id_column], *(table.schema[k] for k in keep), *StructType.fromDDL("vec binary").fields])
    return table.select(id_column, *keep, column).mapInArrow(run, schema)


def integer_vectors(table: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The kept columns and vec: floor(256 * x) of ``embedding`` as little-endian longs; null for null or empty
    vectors, null or non-finite components, and vectors whose integers have a squared length of 2^63 or more
    (an inner product could then exceed a long; of shorter ones none can)."""
    ship(table.sparkSession)

    def whole(x: list | None) -> bytes | None:
        if not x:
            return None
        v = np.floor(256 * np.array(x, dtype=np.float64))  # null components become nan
        size = float(v @ v)
        if not np.isfinite(size) or size > 2.0**64:
            return None
        if size >= 2.0**62 and sum(int(c) ** 2 for c in v) >= 2**63:
            return None
        return v.astype("<i8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore", invalid="ignore"):
                vecs = [whole(x) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(vecs, pa.binary())], names=[*keep, "vec"])

    schema = StructType([*(table.schema[c] for c in keep), *StructType.fromDDL("vec binary").fields])
    return table.select(*keep, "embedding").mapInArrow(run, schema)


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors and bounds of the error's norm, by row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    tiny = 1e-12  # covers the rounding of these sums
    return codes, scale, np.sqrt((decoded**2).sum(axis=1)) + tiny, np.sqrt(((unit - decoded) ** 2).sum(axis=1)) + tiny


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 codes, of any number of dimensions."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT):
        out += a[:, at : at + EXACT].astype(np.float32) @ b[:, at : at + EXACT].astype(np.float32).T
    return out


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of a and b (i < j if both are one tile) with cosine >= threshold."""
    norm_a, norm_b = np.sqrt((a**2).sum(axis=1)), np.sqrt((b**2).sum(axis=1))
    qa, sa, na, ea = quantise(a / norm_a[:, None])
    qb, sb, nb, eb = quantise(b / norm_b[:, None])
    dot = code_products(qa, qb)
    bound = dot * sa[:, None] * sb[None, :] + ea[:, None] * nb[None, :] + na[:, None] * eb[None, :] + ea[:, None] * eb[None, :]
    i, j = np.nonzero(bound >= threshold - 1e-9)
    if same:
        i, j = i[i < j], j[i < j]
    keep = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), CHUNK):
        x, y = i[at : at + CHUNK], j[at : at + CHUNK]
        keep[at : at + CHUNK] = np.einsum("ij,ij->i", a[x], b[y]) / (norm_a[x] * norm_b[y]) >= threshold
    return i[keep], j[keep]


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its connected set."""
    name = np.arange(n)
    while len(i):
        before = name.copy()
        low = np.minimum(name[i], name[j])
        np.minimum.at(name, i, low)
        np.minimum.at(name, j, low)
        np.minimum.at(name, before, name)
        name = name[name]
        if (name == before).all():
            break
    return name


def near_links(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, label, embedding)."""
    staged = Staged(vectors.sparkSession)
    rows = staged.write(valid_vectors(vectors.withColumn("vec_id", F.col("vec_id").cast("long")), zero=False))
    use = rows.where("vec_id is not null and label is not null and vec is not null")
    classes = staged.write(use.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("size")))
    member = use.select("vec_id", "label", "vec").distinct().join(classes, ["label", "vec"]).select("vec_id", "rep", "size")

    sizes = classes.groupBy("label", F.length("vec").alias("bytes")).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiled = classes.withColumn("bytes", F.length("vec")).join(sizes, ["label", "bytes"]).withColumn("own", F.pmod(F.xxhash64("rep"), "tiles").cast("int"))
    both = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "bytes", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "size", "vec"
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        pdf = pdf.sort_values("rep", kind="stable")
        x = np.stack([np.frombuffer(v, "<f8") for v in pdf["vec"]])
        # Scaling by a power of two is exact and keeps squares of large and small values in range.
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
        size, own = pdf["size"].to_numpy(), pdf["own"].to_numpy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        none = pd.DataFrame({"rep": [], "n": [], "low": []})
        if not len(left) or not len(right):
            return none
        a, b = linked_pairs(x[left], x[right], threshold, i == j)
        a, b = left[a], right[b]
        n = np.bincount(a, weights=size[b], minlength=len(x)) + np.bincount(b, weights=size[a], minlength=len(x))
        some = np.flatnonzero(n)
        if not len(some):
            return none
        rep = pdf["rep"].to_numpy()
        return pd.DataFrame({"rep": rep[some], "n": n[some].astype(np.int64), "low": rep[smallest_linked(len(x), a, b)[some]]})

    found = staged.write(both.groupBy("label", "bytes", "i", "j").applyInPandas(compare, "rep long, n long, low long"))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    names = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")), staged).withColumnRenamed("node", "rep")
    each = member.join(links, "rep", "left").join(names, "rep", "left").select(
        "vec_id", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    # An id with several vectors has the links of all; it is in the smallest of their sets.
    each = each.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return rows.select("vec_id").join(each, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))


__all__ = ["code_products", "integer_vectors", "linked_pairs", "near_links", "quantise", "smallest_linked", "valid_vectors"]
