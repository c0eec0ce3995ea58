"""Ranking and threshold metrics over a scored table.

No global window over rows: scores are reduced to one row per distinct
score (partial aggregation) and cumulative counts come from range buckets of
equal depth -- per-bucket totals (prefix-summed in one small task) plus an
ordered window inside each bucket.  Threshold grids count rows per
grid cell (grid size + 1 groups at most) and suffix-sum that tiny table.
Only the bucket bounds and scalars (class totals) reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.operators.ranking import running_sums
from orderlens.session import stage_table

DEC = "decimal(38,0)"


def grid(lo: float, hi: float, step: float) -> list[float]:
    """Thresholds as numpy's ``arange(lo, hi, step)`` yields them."""
    delta = (lo + step) - lo
    n = int(math.ceil((hi - lo) / step))
    return [lo + i * delta for i in range(n)]


F1_GRID = dict(lo=0.05, hi=0.81, step=0.01)     # best-F1 search
SWEEP_GRID = dict(lo=0.05, hi=0.96, step=0.01)  # threshold sweep


def score_counts(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row per distinct score: positives and negatives."""
    return (df.groupBy(F.col(p).alias("s"))
              .agg(F.sum(F.col(y)).cast("long").alias("pos"), F.count(F.lit(1)).alias("n"))
              .select("s", "pos", (F.col("n") - F.col("pos")).alias("neg")))


#: Score buckets: two levels of equal depth, so that a row is placed by 2 * FAN comparisons.
FAN = 32


def score_bounds(counts: DataFrame) -> list[float]:
    """Scores that cut the distinct scores into up to FAN * FAN parts of about equal depth."""
    steps = [k / (FAN * FAN) for k in range(1, FAN * FAN)]
    got = counts.agg(F.percentile_approx("s", steps, 20 * FAN * FAN).alias("b")).first()["b"] or []
    return sorted(set(got))


def bucket_index(s: Column, bounds: list[float]) -> Column:
    """Number of bounds below ``s``: first among every FAN-th bound, then in the part between."""
    if not bounds:
        return F.lit(0)
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.array(*[F.lit(b) for b in bounds[FAN - 1::FAN]]) if len(bounds) >= FAN else F.array().cast("array<double>")
    block = F.size(F.filter(coarse, lambda b: b < s))
    rest = F.slice(every, block * FAN + 1, F.lit(FAN))
    return block * FAN + F.size(F.filter(rest, lambda b: b < s))


def cumulative_below(counts: DataFrame) -> DataFrame:
    """Add ``pos_below``/``neg_below`` (counts at strictly smaller scores).

    Buckets of equal depth hold about as many distinct scores each, however the
    scores cluster, so no task's window grows beyond its share."""
    c = counts.withColumn("b", bucket_index(F.col("s"), score_bounds(counts)))
    per_b = c.groupBy("b").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    # at most FAN * FAN rows: an unpartitioned window over them is one small task
    wb = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    per_b = per_b.select("b", F.coalesce(F.sum("bpos").over(wb), F.lit(0)).alias("bpos_before"),
                         F.coalesce(F.sum("bneg").over(wb), F.lit(0)).alias("bneg_before"))
    wi = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumns({"ipos": F.coalesce(F.sum("pos").over(wi), F.lit(0)),
                       "ineg": F.coalesce(F.sum("neg").over(wi), F.lit(0))})
    j = c.join(F.broadcast(per_b), "b")  # FAN * FAN rows at most
    return j.select("s", "pos", "neg",
                    (F.col("bpos_before") + F.col("ipos")).cast("long").alias("pos_below"),
                    (F.col("bneg_before") + F.col("ineg")).cast("long").alias("neg_below"))


def ranking(df: DataFrame, y: str = "y", p: str = "p"):
    """(cumulative table, P, N) for a scored frame; the score table is staged once."""
    counts = stage_table(score_counts(df, y, p), "scores")
    r = counts.agg(F.sum("pos"), F.sum("neg")).first()
    return cumulative_below(counts), int(r[0] or 0), int(r[1] or 0)


def auc_ap(cum: DataFrame, P: int, N: int) -> DataFrame:  # noqa: N803
    """One row: ROC-AUC (ties count half) and average precision (step sum
    over distinct scores, descending); NULL unless both classes occur."""
    tp_ge = F.lit(P) - F.col("pos_below")
    fp_ge = F.lit(N) - F.col("neg_below")
    out = cum.agg(
        F.sum(F.col("pos").cast(DEC) * (F.col("neg_below") * 2 + F.col("neg")).cast(DEC)).alias("num"),
        F.sum(F.when(F.col("pos") > 0, (F.col("pos") / F.lit(float(max(P, 1))))
                     * (tp_ge / (tp_ge + fp_ge))).otherwise(F.lit(0.0))).alias("ap"))
    both = P > 0 and N > 0
    return out.select(
        (F.col("num").cast("double") / (F.lit(2.0) * F.lit(P) * F.lit(N)) if both
         else F.lit(None).cast("double")).alias("roc_auc"),
        (F.col("ap") if both else F.lit(None).cast("double")).alias("pr_auc"))


def roc_points(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """M8: (threshold, fpr, tpr) at every distinct score (no points dropped)."""
    cum, P, N = ranking(df, y, p)  # noqa: N806
    return cum.select(F.col("s").alias("threshold"),
                      ((F.lit(N) - F.col("neg_below")) / F.lit(N)).alias("fpr"),
                      ((F.lit(P) - F.col("pos_below")) / F.lit(P)).alias("tpr"))


def confusion_counts(df: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    pred = F.col(p) >= F.lit(threshold)
    yy = F.col(y) == 1
    s = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return df.agg(s(yy & pred).alias("tp"), s(~yy & pred).alias("fp"),
                  s(yy & ~pred).alias("fn"), s(~yy & ~pred).alias("tn"))


def classification_metrics(df: DataFrame, threshold: float = 0.5, y: str = "y",
                           p: str = "p") -> DataFrame:
    """M7: one row of metrics at ``threshold``; MCC/AUC/AP NULL with one class."""
    cum, P, N = ranking(df, y, p)  # noqa: N806
    cc = confusion_counts(df, threshold, y, p)
    ra = auc_ap(cum, P, N).first()
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    d = lambda c: c.cast("double")
    n = tp + fp + fn + tn
    both = P > 0 and N > 0
    if P > 0 and N > 0:
        bal = (d(tp) / P + d(tn) / N) / 2.0
    elif P > 0:
        bal = d(tp) / P
    else:
        bal = d(tn) / max(N, 1)
    t_true = [F.lit(float(N)), F.lit(float(P))]
    p_sum = [d(tn + fn), d(tp + fp)]
    nn = d(n)
    cov_ytyp = d(tp + tn) * nn - (t_true[0] * p_sum[0] + t_true[1] * p_sum[1])
    cov_ypyp = nn * nn - (p_sum[0] * p_sum[0] + p_sum[1] * p_sum[1])
    cov_ytyt = nn * nn - (t_true[0] * t_true[0] + t_true[1] * t_true[1])
    mcc = F.when(cov_ytyt * cov_ypyp == 0, F.lit(0.0)).otherwise(cov_ytyp / F.sqrt(cov_ytyt * cov_ypyp))
    safe = lambda a, b: F.when(b > 0, d(a) / d(b)).otherwise(F.lit(0.0))
    return cc.select(
        F.lit(float(threshold)).alias("threshold"),
        (d(tp + tn) / d(n)).alias("accuracy"),
        safe(tp, tp + fp).alias("precision"),
        safe(tp, tp + fn).alias("recall"),
        safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
        bal.alias("balanced_accuracy"),
        (mcc if both else F.lit(None).cast("double")).alias("mcc"),
        F.lit(ra["roc_auc"]).cast("double").alias("roc_auc"),
        F.lit(ra["pr_auc"]).cast("double").alias("pr_auc"),
        "tn", "fp", "fn", "tp", n.alias("n"),
        (F.lit(float(P)) / d(n)).alias("positive_rate"))


def grid_cell(s: Column, thresholds: list[float]):
    """k = #{i: thresholds[i] <= s} of an even grid, and the function from an index to its threshold."""
    n = len(thresholds)
    lo = thresholds[0]
    delta = thresholds[1] - thresholds[0] if n > 1 else 1.0
    t_at = lambda k: F.lit(lo) + k.cast("double") * F.lit(delta)
    k0 = F.least(F.greatest(F.floor((s - F.lit(lo)) / F.lit(delta)) + 1, F.lit(0)), F.lit(n))
    k1 = F.when((k0 >= 1) & (s < t_at(k0 - 1)), k0 - 1).otherwise(k0)
    return F.when((k1 < n) & (s >= t_at(k1)), k1 + 1).otherwise(k1).cast("int"), t_at


def metrics_by(df: DataFrame, keys: list[str], y: str = "y", p: str = "p", grid_of: dict | None = None) -> DataFrame:
    """M6, M7 and W6 for many models, months or both at once: per ``keys`` the rows, positives,
    ROC-AUC, average precision, and the best F1 of the grid with its threshold.

    The scored table is read twice, whatever the number of keys: once for the ranking (one row
    per key and distinct score, running counts from the top by :func:`running_sums`, so a key
    with most of the rows still spreads over tasks) and once for the grid (at most grid + 1 rows
    a key).  NULL scores are left out; AUC and AP are NULL for one class; (0.0, 0.5) where no
    threshold gives F1 > 0."""
    df = df.where(F.col(p).isNotNull())
    group = [F.col(f"`{k}`") for k in keys]
    counts = df.groupBy(*group, F.col(p).alias("__s")).agg(F.sum(F.col(y)).cast("long").alias("__pos"),
                                                            F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__neg", F.col("__n") - F.col("__pos"))
    cum = running_sums(counts, keys, [F.desc("__s")], {"__tp": F.col("__pos"), "__fp": F.col("__neg")})
    pos, neg, tp, fp = (F.col(f"__{c}") for c in ("pos", "neg", "tp", "fp"))
    sums = cum.groupBy(*group).agg(
        F.sum("__n").alias("n"), F.sum(pos).alias("n_pos"),
        F.sum(pos.cast(DEC) * (fp * 2 - neg).cast(DEC)).alias("__over"),
        F.sum(F.when(pos > 0, pos * (tp / (tp + fp))).otherwise(F.lit(0.0))).alias("__ap"))
    P, N = F.col("n_pos"), F.col("n") - F.col("n_pos")  # noqa: N806
    both = (P > 0) & (N > 0)
    pairs = P.cast(DEC) * N.cast(DEC) * 2
    ranked = sums.select(*group, "n", "n_pos",
                         F.when(both, (pairs - F.col("__over")).cast("double") / pairs.cast("double")).alias("roc_auc"),
                         F.when(both, F.col("__ap") / P).alias("pr_auc"))

    k, t_at = grid_cell(F.col(p), grid(**(grid_of or F1_GRID)))
    cells = df.groupBy(*group, k.alias("__k")).agg(F.sum(F.col(y)).cast("long").alias("__pos"), F.count(F.lit(1)).alias("__n"))
    # at most grid + 1 cells a key; a threshold counts the cells above it, so F1 changes at cells only
    down = Window.partitionBy(*group).orderBy(F.desc("__k")).rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(*group)
    step = Window.partitionBy(*group).orderBy("__k")
    cells = cells.select(*group, "__k", F.sum("__pos").over(down).alias("__tp"), F.sum(F.col("__n") - F.col("__pos")).over(down).alias("__fp"),
                         F.sum("__pos").over(total).alias("__all"), F.coalesce(F.lag("__k").over(step), F.lit(0)).alias("__i"))
    f1 = F.when(F.col("__k") > 0, _f1(tp, fp, F.col("__all") - tp)).otherwise(F.lit(0.0))
    best = cells.groupBy(*group).agg(F.max(F.struct(f1.alias("f1"), (-F.col("__i")).alias("i"))).alias("__b"))
    found = F.col("__b.f1") > 0
    best = best.select(*[g.alias(f"__k{j}") for j, g in enumerate(group)],
                       F.when(found, F.col("__b.f1")).otherwise(F.lit(0.0)).alias("best_f1"),
                       F.when(found, t_at(-F.col("__b.i"))).otherwise(F.lit(0.5)).alias("best_threshold"))
    meets = F.lit(True)
    for j, g in enumerate(group):
        meets = meets & g.eqNullSafe(F.col(f"__k{j}"))
    return ranked.join(best, meets).drop(*[f"__k{j}" for j in range(len(group))])


def grid_counts(df: DataFrame, thresholds: list[float], y: str = "y", p: str = "p") -> DataFrame:
    """Per threshold index ``i``: tp/fp/fn/tn of ``p >= thresholds[i]``.

    Each row is assigned k = #{i: thresholds[i] <= p} (arithmetic estimate,
    corrected against the exact grid values), rows are counted per k, and
    the (len+1)-row table is suffix-summed.
    """
    n = len(thresholds)
    k, t_at = grid_cell(F.col(p), thresholds)
    per_k = (df.groupBy(k.alias("k"))
               .agg(F.sum(F.col(y)).cast("long").alias("pos"), F.count(F.lit(1)).alias("cnt")))
    totals = per_k.agg(F.sum("pos").alias("P"), F.sum("cnt").alias("T")).first()
    P, T = int(totals["P"] or 0), int(totals["T"] or 0)  # noqa: N806
    g = df.sparkSession.range(n).select(F.col("id").cast("int").alias("i"))
    g = g.join(F.broadcast(per_k), F.col("k") == F.col("i") + 1, "left")
    # the grid has ``n`` rows: a suffix sum over it is one small task
    w = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    g = g.select("i", F.sum(F.coalesce("pos", F.lit(0))).over(w).alias("tp"),
                 F.sum(F.coalesce(F.col("cnt") - F.col("pos"), F.lit(0))).over(w).alias("fp"))
    return g.select(
        "i", t_at(F.col("i")).alias("threshold"),
        F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
        (F.lit(P) - F.col("tp")).cast("long").alias("fn"),
        (F.lit(T - P) - F.col("fp")).cast("long").alias("tn"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    den = 2 * tp + fp + fn
    return F.when(den > 0, (2 * tp).cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def best_f1_threshold(df: DataFrame, y: str = "y", p: str = "p", lo: float = 0.05,
                      hi: float = 0.81, step: float = 0.01) -> DataFrame:
    """M6: one row (best_f1, best_threshold); first strict maximum wins;
    (0.0, 0.5) when no threshold gives F1 > 0."""
    g = grid_counts(df, grid(lo, hi, step), y, p)
    g = g.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))
    best = g.where(F.col("f1") > 0).orderBy(F.desc("f1"), F.asc("i")).limit(1)
    fallback = df.sparkSession.range(1).select(F.lit(0.0).alias("f1"), F.lit(0.5).alias("threshold"),
                                               F.lit(1 << 30).alias("i"))
    both = best.select("f1", "threshold", "i").unionByName(fallback)
    return (both.orderBy("i").limit(1)
                .select(F.col("f1").alias("best_f1"), F.col("threshold").alias("best_threshold")))


def threshold_sweep(df: DataFrame, y: str = "y", p: str = "p", lo: float = 0.05,
                    hi: float = 0.96, step: float = 0.01) -> DataFrame:
    """M9: precision/recall/F1 at each threshold that predicts both classes."""
    g = grid_counts(df, grid(lo, hi, step), y, p)
    pred_pos = F.col("tp") + F.col("fp")
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    g = g.where((pred_pos > 0) & (pred_pos < total))
    rec_den = F.col("tp") + F.col("fn")
    return g.select(
        "threshold",
        (F.col("tp").cast("double") / pred_pos.cast("double")).alias("precision"),
        F.when(rec_den > 0, F.col("tp").cast("double") / rec_den.cast("double"))
         .otherwise(F.lit(0.0)).alias("recall"),
        _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def best_of_sweep(sweep: DataFrame) -> tuple[float, float]:
    """(best threshold, best F1) of a sweep: first threshold with the highest
    F1; raises when no threshold predicts both classes."""
    r = sweep.orderBy(F.desc("f1"), F.asc("threshold")).limit(1).collect()
    if not r:
        raise ValueError("threshold sweep: no threshold predicts both classes")
    return float(r[0]["threshold"]), float(r[0]["f1"])


def confusion_normalized(df: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """Counts of (true, predicted) divided by the true-class total."""
    c = (df.groupBy(F.col(y).cast("int").alias("y_true"),
                    (F.col(p) >= F.lit(threshold)).cast("int").alias("y_pred"))
           .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("y_true")  # at most 2x2 rows
    return c.withColumn("share", F.col("n") / F.sum("n").over(w))
