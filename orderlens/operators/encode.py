"""Encoders (E1-E6): one-hot, scaling, pass-through, smoothed target
encoding (plain and out-of-fold) and the assembled feature vector.

Target encoding is one aggregate per column: sums by (value) for the plain
map, by (value, fold) for out-of-fold values, where the other folds' sums
are the value total minus the own fold -- one group-by instead of k.
The global mean is a scalar; maps are joined back by equi-join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.functions.ops import Val, plain_text, to_double
from orderlens.operators.lookups import left_lookup
from orderlens.operators.ranking import ranked, running_sums


def global_mean(df: DataFrame, target: str) -> float:
    """A5: mean target, 0.5 when there are no rows."""
    r = df.agg(F.sum(F.col(target)).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return float(r["s"]) / r["n"] if r["n"] else 0.5


def smoothed(sum_y: Column, n: Column, g: float, alpha: float) -> Column:
    """(sum + g*alpha) / (n + alpha)."""
    return (sum_y + F.lit(g) * F.lit(alpha)) / (n + F.lit(alpha))


def target_map(df: DataFrame, col: str, target: str, alpha: float, g: float) -> DataFrame:
    """A4: value -> smoothed mean; NULL values are left out."""
    v = F.col(f"`{col}`")
    return (df.where(v.isNotNull()).groupBy(v.alias("value"))
              .agg(F.sum(F.col(target)).alias("s"), F.count(F.lit(1)).alias("n"))
              .select("value", smoothed(F.col("s"), F.col("n"), g, alpha).alias("te")))


def apply_target_map(df: DataFrame, col: str, tmap: DataFrame, g: float, out: str, heavy: list | tuple = ()) -> DataFrame:
    """Left lookup; unseen or NULL -> global mean.  ``heavy``: values to spread (``lookups.heavy_values``)."""
    t = tmap.select(F.col("value").alias("__te_v"), F.col("te").alias("__te"))
    j = left_lookup(df, F.col(f"`{col}`"), t, "__te_v", heavy)
    return j.withColumn(out, F.coalesce(F.col("__te"), F.lit(g))).drop("__te")


def oof_target_encode(df: DataFrame, col: str, target: str, fold: str, alpha: float,
                      g: float, out: str, heavy: list | tuple = ()) -> DataFrame:
    """E5: each row's value from the other folds' statistics; the global
    mean is over all training rows; no other-fold rows or NULL -> mean.
    ``heavy``: values to spread (``lookups.heavy_values``)."""
    return apply_oof(df, col, fold, oof_map(df, col, target, fold, alpha, g), g, out, heavy)


def oof_map(df: DataFrame, col: str, target: str, fold: str, alpha: float, g: float) -> DataFrame:
    """E5 as a table: (value, fold, te), the smoothed mean of a value over the other folds."""
    v = F.col(f"`{col}`")
    by = (df.where(v.isNotNull()).groupBy(v.alias("value"), F.col(fold).alias("fold"))
            .agg(F.sum(F.col(target)).alias("s"), F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("value")  # over the (value, fold) table: <= k rows per value
    so, no = F.sum("s").over(w) - F.col("s"), F.sum("n").over(w) - F.col("n")
    return by.select("value", "fold", F.when(no > 0, smoothed(so, no, g, alpha)).otherwise(F.lit(g)).alias("te"))


def apply_oof(df: DataFrame, col: str, fold: str, table: DataFrame, g: float, out: str, heavy: list | tuple = ()) -> DataFrame:
    """Each row's value of ``oof_map`` by its value and fold; else the mean."""
    v = F.col(f"`{col}`")
    t = table.select(F.struct(F.col("value").alias("__v"), F.col("fold").alias("__f")).alias("__vf"), F.col("te").alias("__te"))
    key = F.when(v.isNotNull(), F.struct(v.alias("__v"), F.col(f"`{fold}`").alias("__f")))
    j = left_lookup(df, key, t, "__vf", heavy, (v, F.col("__vf.__v")))
    return j.withColumn(out, F.coalesce("__te", F.lit(g))).drop("__te")


def ordered_target_statistics(df: DataFrame, cols: list[str], target: str, alpha: float, g: float,
                              outs: list[str], order: list[Column | str] | None = None,
                              row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """M3's encoding: the smoothed mean target of the rows that come before a row in a seeded
    permutation and share its value; (g) for the first one.  NULL is a value of its own.

    ``order`` (default: a seeded hash of the row id, then the id) must be unique; running sums by
    range partition, so a value with most of the rows spreads over tasks."""
    order = order or [F.xxhash64(F.col(row_id), F.lit(seed)), F.col(row_id)]
    for c, out in zip(cols, outs, strict=True):
        y = F.col(target).cast("double")
        df = running_sums(df, [c], order, {"__s": y, "__n": F.lit(1).cast("long")})
        df = df.withColumn(out, smoothed(F.col("__s") - y, F.col("__n") - 1, g, alpha)).drop("__s", "__n")
    return df


def hash_folds(row_id: Column, k: int, seed: int = 42) -> Column:
    """A fold by a seeded hash of the row id: balanced on average only, but free of any shuffle."""
    return F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(k)).cast("int")


def stratified_folds(df: DataFrame, target: str, k: int, fold: str = "fold", row_id: str = "row_id", seed: int = 42,
                     order: list[Column | str] | None = None) -> DataFrame:
    """Exact stratified shuffled folds.  Each class is put in a seeded order (``order`` is
    unique; default a hash of the row id, then the id) and dealt out in turn, each class going on
    where the one before stopped: both a class's folds and whole folds differ by one row at most."""
    order = order or [F.xxhash64(F.col(row_id), F.lit(seed)), F.col(row_id)]
    out = ranked(df, order, "__r", [target])
    sizes = df.groupBy(F.col(target).alias("__t")).agg(F.count(F.lit(1)).alias("__n"))  # one row a class
    before = Window.orderBy(F.asc_nulls_first("__t")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__t", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    out = out.join(F.broadcast(starts), F.col(target).eqNullSafe(F.col("__t")))  # classes
    return out.withColumn(fold, ((F.col("__start") + F.col("__r") - 1) % k).cast("int")).drop("__t", "__start", "__r")


def n_folds(n_pos: int, n_neg: int, requested: int = 5) -> int:
    """k = min(requested, max(2, positives, negatives)) -- the original rule."""
    return min(requested, int(max(2, n_pos, n_neg)))


def onehot_long(df: DataFrame, cols: list[str], id_col: str = "row_id") -> DataFrame:
    """E1 in long form: one row per (row, categorical feature) with a
    non-NULL value; ``slot`` is the value's position among the feature's
    sorted values (NULL -> no row, i.e. an all-zero block)."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"),
                               plain_text(Val(F.col(f"`{c}`"), df.schema[c].dataType)).alias("category"))
                      for c in cols])
    long = (df.select(F.col(id_col), F.explode(items).alias("kv"))
              .select(id_col, "kv.feature", "kv.category")
              .where(F.col("category").isNotNull()))
    vocab = ranked(long.select("feature", "category").distinct(), ["category"], "slot", ["feature"])
    vocab = vocab.withColumn("slot", (F.col("slot") - 1).cast("int"))
    return (long.join(vocab, ["feature", "category"])
                .select(id_col, "feature", "category",
                        F.concat(F.col("feature"), F.lit("_"), F.col("category")).alias("onehot_col"),
                        "slot"))


@dataclass
class ScaleStats:
    mean: float
    std: float


def scale_stats(df: DataFrame, col: str) -> ScaleStats:
    """E2 fit: NULL -> 0, population std, zero std -> 1."""
    x = F.coalesce(to_double(Val(F.col(f"`{col}`"), df.schema[col].dataType)), F.lit(0.0))
    r = df.agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")).first()
    return ScaleStats(r["mean"] or 0.0, r["std"] or 1.0)


def scaled(df: DataFrame, col: str, st: ScaleStats) -> Column:
    x = F.coalesce(to_double(Val(F.col(f"`{col}`"), df.schema[col].dataType)), F.lit(0.0))
    return (x - F.lit(st.mean)) / F.lit(st.std)


def passthrough(df: DataFrame, col: str) -> Column:
    """Number, bad or NULL -> 0."""
    return F.coalesce(to_double(Val(F.col(f"`{col}`"), df.schema[col].dataType)), F.lit(0.0))
