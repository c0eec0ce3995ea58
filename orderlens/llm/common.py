"""Shared helpers of the corpus operators: staging, hashing, sorted group maps."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd 64-bit multipliers for mixing (golden ratio and xxHash primes).
M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xC2B2AE3D27D4EB4F)
M3 = np.uint64(0x165667B19E3779F9)


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without the setting (tests) gets a folder of its own; a
    cluster without it is an error, because executors don't see the driver's disk.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="orderlens-llm-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's source to the executors, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_orderlens_sent", False):
        return spark
    package = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="orderlens-src-")) / "orderlens_src.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(package.rglob("*")):
            if f.suffix in {".py", ".yaml"}:
                z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(out))
    sc._orderlens_sent = True
    return spark


class Staged:
    """Tables written to the shared folder: they cut lineage, survive lost executors,
    and :meth:`drop` deletes those no later step reads."""

    def __init__(self, spark: SparkSession):
        self.spark = ship(spark)
        self.root = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count:03d}"
        df.write.parquet(path)
        # The written table replaces the shuffles behind it. Spark deletes their files once the
        # driver's JVM has collected what refers to them, which a small driver may not do for
        # long; what the first collection frees lets the second one find them.
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(df._staged_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def group_count(total: int, per_group: int, least: int = 8) -> int:
    """Groups so that each holds about ``per_group`` of ``total``."""
    return max(least, -(-int(total) // per_group))


def bucket_of(col: Column | str, n: int, seed: int = 0) -> Column:
    """A deterministic bucket in [0, n) of a column."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(n)).cast("int")


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Mix 64-bit integers (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sorted_groups(
    df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str, order: list[str] | None = None
) -> DataFrame:
    """Apply ``fn`` to each group of ``keys``: rows are hash-partitioned by the keys and
    sorted, and groups are cut from the stream of Arrow batches. Unlike one call of
    Python per group this stays cheap for very many small groups, and a task holds one
    group and one batch at a time; sorting spills to disk."""
    ordered = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        out: list[pd.DataFrame] = []
        rows = 0
        for pdf in batches:
            if not len(pdf):
                continue
            change = np.zeros(len(pdf), dtype=bool)
            for k in keys:
                v = pdf[k].to_numpy()
                change[1:] |= v[1:] != v[:-1]
            first = tuple(pdf[k].iloc[0] for k in keys)
            change[0] = last is None or first != last
            cuts = [*np.flatnonzero(change), len(pdf)]
            if cuts[0] > 0:
                held.append(pdf.iloc[: cuts[0]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held:
                    got = fn(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0])
                    if got is not None and len(got):
                        out.append(got)
                        rows += len(got)
                held = [pdf.iloc[a:b]]
                if rows >= 5000:
                    yield pd.concat(out, ignore_index=True)
                    out, rows = [], 0
            last = tuple(pdf[k].iloc[-1] for k in keys)
        if held:
            got = fn(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0])
            if got is not None and len(got):
                out.append(got)
        if out:
            yield pd.concat(out, ignore_index=True)

    return ordered.mapInPandas(run, schema)


class Forest:
    """Union-find over 0..n-1 for the members of one bounded group."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True
