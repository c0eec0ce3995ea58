"""Importance, comparison and calibration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.functions.ops import Val, plain_text


def grouped_importance(coefs: DataFrame, top_n: int = 25) -> DataFrame:
    """Sum of |weight| per source feature, top n by importance (O4 =
    TakeOrderedAndProject).  ``coefs`` has a row for each model column with its
    ``weight`` and, if known, the ``feature`` it was made from; otherwise the
    column's ``name`` is the feature."""
    key = (F.coalesce("feature", "name") if {"feature", "name"} <= set(coefs.columns)
           else F.col("feature" if "feature" in coefs.columns else "name"))
    g = coefs.groupBy(key.alias("feature")).agg(F.sum(F.abs("weight")).alias("importance"))
    top = g.orderBy(F.desc("importance"), F.asc("feature")).limit(top_n)
    w = Window.orderBy(F.desc("importance"), F.asc("feature"))  # over <= top_n rows
    return top.withColumn("rank", F.row_number().over(w).cast("int"))


def univariate_importance(df: DataFrame, cat_cols: list[str], target: str,
                          top_n: int = 25) -> DataFrame:
    """Grouped importance of one-hot columns weighted by their univariate
    effect (pos_c * N - n_c * P) / N^2, summed exactly per feature."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"),
                               plain_text(Val(F.col(f"`{c}`"), df.schema[c].dataType)).alias("category"))
                      for c in cat_cols])
    tot = df.agg(F.count(F.lit(1)).alias("N"), F.sum(target).alias("P")).first()
    n_all, p_all = int(tot["N"]), int(tot["P"] or 0)
    long = (df.select(F.col(target).alias("y"), F.explode(items).alias("kv"))
              .select("y", "kv.feature", "kv.category").where(F.col("category").isNotNull()))
    w = long.groupBy("feature", "category").agg(F.sum("y").cast("long").alias("pos"),
                                                F.count(F.lit(1)).alias("n"))
    coefs = w.select("feature", (F.col("pos") * F.lit(n_all) - F.col("n") * F.lit(p_all)).cast("decimal(38,0)")
                     .alias("weight"))
    imp = grouped_importance(coefs, top_n)
    denom = float(n_all) * n_all
    return imp.select("feature", (F.col("importance").cast("double") / F.lit(denom)).alias("importance"),
                      "rank")


def compare_models(metric_rows: dict[str, DataFrame], metrics: list[str]) -> DataFrame:
    """Metric x model; a metric NULL for every model is left out."""
    parts = []
    for name, row in metric_rows.items():
        stack = ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in metrics)
        parts.append(row.selectExpr(f"stack({len(metrics)}, {stack}) AS (metric, value)")
                        .withColumn("model", F.lit(name)))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    names = list(metric_rows)
    wide = long.groupBy("metric").pivot("model", names).agg(F.first("value", ignorenulls=True))
    keep = None
    for n in names:
        c = F.col(n).isNotNull()
        keep = c if keep is None else keep | c
    return wide.where(keep)
