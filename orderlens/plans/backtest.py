"""Time splits (M11) and the expanding-month backtest.

Counts and rates of every split come from one grouped pass (per-month
totals, prefix-summed over at most the number of months).  The loop takes any
``train_fn`` and fits one month at a time, a few side by side; all months'
scores then go through one keyed ranking.  ``plans.rolling`` fits the
full-feature logistic models of all months in joint passes instead.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.operators import metrics as met
from orderlens.operators.lookups import SALTS, heavy_values
from orderlens.schema import DATE_COL, ROW_ID, TARGET
from orderlens.session import stage_table

TrainFn = Callable[[DataFrame, DataFrame], DataFrame]  # -> (row_id, proba) for test rows


PERIOD_FORMATS = {"month": "yyyy-MM", "year": "yyyy"}


def month_col(date_col: str = DATE_COL, period: str = "month"):
    return F.date_format(F.col(date_col), PERIOD_FORMATS[period])


def split_by_month(df: DataFrame, train_through: str, test_month: str,
                   date_col: str = DATE_COL) -> tuple[DataFrame, DataFrame]:
    """train = months <= ``train_through``, test = ``test_month``
    ('YYYY-MM'); rows without a date are in neither."""
    d = F.col(date_col)
    start = lambda month, after: F.add_months(F.lit(f"{month}-01").cast("date"), after).cast(df.schema[date_col].dataType)
    # ranges of the date itself, which reach the scan as pushed filters
    return (df.filter(d < start(train_through, 1)),
            df.filter((d >= start(test_month, 0)) & (d < start(test_month, 1))))


def split_counts(df: DataFrame, train_through: str, test_month: str, target: str = TARGET,
                 date_col: str = DATE_COL) -> DataFrame:
    m = month_col(date_col)
    tr, te = m <= train_through, m == test_month
    cnt = lambda c: F.count(F.when(c, 1))
    pos = lambda c: F.sum(F.when(c, F.col(target)))
    return df.agg(
        F.lit(train_through).alias("train_through"), F.lit(test_month).alias("test_month"),
        cnt(tr).alias("n_train"), cnt(te).alias("n_test"),
        F.try_divide(pos(tr), cnt(tr)).cast("double").alias("train_buyout"),
        F.try_divide(pos(te), cnt(te)).cast("double").alias("test_buyout"))


def expanding_month_counts(df: DataFrame, target: str = TARGET, date_col: str = DATE_COL,
                           keep_skipped: bool = False, period: str = "month") -> DataFrame:
    """Every observed month but the first: train = all earlier months.
    Splits with one class in train or test are dropped (``keep_skipped``
    keeps them with a ``skipped`` flag)."""
    pm = (df.where(F.col(date_col).isNotNull()).groupBy(month_col(date_col, period).alias("test_month"))
            .agg(F.count(F.lit(1)).alias("n_test"), F.sum(target).cast("long").alias("pos")))
    # one row per month: the unpartitioned window is bounded by the time span
    w = Window.orderBy("test_month").rowsBetween(Window.unboundedPreceding, -1)
    cm = pm.select("test_month", "n_test", "pos",
                   F.coalesce(F.sum("n_test").over(w), F.lit(0)).cast("long").alias("n_train"),
                   F.coalesce(F.sum("pos").over(w), F.lit(0)).alias("pos_train"),
                   F.row_number().over(Window.orderBy("test_month")).alias("k"))
    ok = ((F.col("pos_train") > 0) & (F.col("pos_train") < F.col("n_train"))
          & (F.col("pos") > 0) & (F.col("pos") < F.col("n_test")))
    cm = cm.where(F.col("k") > 1)
    out = cm.select("test_month", "n_train", "n_test",
                    (F.col("pos_train") / F.col("n_train")).alias("train_buyout"),
                    (F.col("pos") / F.col("n_test")).alias("test_buyout"),
                    (~ok).alias("skipped"))
    return out if keep_skipped else out.where(~F.col("skipped")).drop("skipped")


def evaluated(scores: DataFrame, df: DataFrame, target: str = TARGET, date_col: str = DATE_COL,
              period: str = "month") -> DataFrame:
    """Counts of every split of ``df`` next to AUC and best F1 of its scores (test_month, y, p)."""
    found = met.metrics_by(stage_table(scores, "backtest_scores"), ["test_month"])
    counts = expanding_month_counts(df, target, date_col, period=period)
    return counts.join(found, "test_month").select(
        "test_month", "n_train", "n_test", "train_buyout", "test_buyout", F.col("roc_auc").alias("test_auc"),
        F.col("best_f1").alias("test_f1"), "best_threshold")


def cumulative_months_loop(df: DataFrame, train_fn: TrainFn, target: str = TARGET,
                           date_col: str = DATE_COL, months: list[str] | None = None,
                           parallelism: int = 2, period: str = "month") -> DataFrame:
    """For each eligible month, fit on all earlier months, score the
    month, and report AUC and best F1 next to the split counts.

    ``months`` limits which test months are evaluated (default: all);
    ``period='year'`` runs the same protocol on calendar years.
    """
    base = stage_table(df.where(F.col(date_col).isNotNull()).withColumn("__m", month_col(date_col, period)), "backtest_base")
    splits = [r["test_month"] for r in expanding_month_counts(base, target, date_col, period=period).collect()]  # one row per period
    if months is not None:
        splits = [m for m in splits if m in set(months)]

    def one(m):
        train = base.filter(F.col("__m") < m).drop("__m")
        test = base.filter(F.col("__m") == m).drop("__m")
        proba = train_fn(train, test)
        scored = test.select(ROW_ID, F.col(target).alias("y")).join(proba, ROW_ID)
        return scored.select(F.lit(m).alias("test_month"), "y", F.col("proba").alias("p"))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scores = list(pool.map(one, splits))
    if not scores:
        scores = [base.limit(0).select(F.col("__m").alias("test_month"), F.col(target).alias("y"), F.lit(0.0).alias("p"))]
    return evaluated(reduce(DataFrame.unionByName, scores), base, target, date_col, period)


def target_map_intervals(df: DataFrame, col: str, target: str = TARGET, date_col: str = DATE_COL,
                         period: str = "month") -> DataFrame:
    """A4 as of every period: (value, after, upto, s, n), the rows and positives of a value that
    hold for test periods later than ``after`` up to and with ``upto`` (NULL: all later ones).

    One row per value and period in which it occurs, so as many as the data have, however many
    test periods there are."""
    base = df.where(F.col(date_col).isNotNull() & F.col(f"`{col}`").isNotNull())
    by = (base.groupBy(F.col(f"`{col}`").alias("value"), month_col(date_col, period).alias("after"))
              .agg(F.sum(target).cast("long").alias("s"), F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("value").orderBy("after")  # <= number of periods per value
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    return by.select("value", "after", F.lead("after").over(w).alias("upto"),
                     F.sum("s").over(so_far).alias("s"), F.sum("n").over(so_far).alias("n"))


def target_map_as_of(df: DataFrame, col: str, alpha: float, target: str = TARGET, date_col: str = DATE_COL,
                     period: str = "month", out: str = "te") -> DataFrame:
    """``df``'s dated rows with the smoothed mean target of their value over all earlier periods
    (the global mean of those periods for NULL and new values, 0.5 in the first period).

    An as-of join: intervals are filed under every calendar year they reach into, rows under
    their own, and the two meet by (value, year); heavy values are spread."""
    period_of = month_col(date_col, period)
    rows = df.where(F.col(date_col).isNotNull())
    per = rows.groupBy(period_of.alias("__p")).agg(F.count(F.lit(1)).alias("__n"), F.sum(target).alias("__s"))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row per period
    mean = F.when(F.sum("__n").over(w) > 0, F.sum("__s").over(w) / F.sum("__n").over(w)).otherwise(F.lit(0.5))
    means = per.select("__p", mean.alias("__g"))
    last = F.lit(per.agg(F.max("__p")).first()[0])
    year = lambda c: F.substring(c, 1, 4).cast("int")
    filed = target_map_intervals(df, col, target, date_col, period).select(
        F.col("value").alias("__value"), "after", "upto", F.col("s").alias("__vs"), F.col("n").alias("__vn"),
        F.explode(F.sequence(year(F.col("after")), year(F.coalesce("upto", last)))).alias("__year"))
    v = F.col(f"`{col}`")
    heavy = heavy_values(rows, [col])[col]
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS))
    salt = F.when(v.isNull() | (v.isin(*heavy) if heavy else F.lit(False)), own).otherwise(F.lit(0))
    copies = F.array(F.lit(0).cast("long"))
    if heavy:
        copies = F.when(F.col("__value").isin(*heavy), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(copies)
    filed = filed.withColumn("__copy", F.explode(copies))
    at = rows.withColumns({"__p": period_of, "__salt": salt.cast("long")}).withColumn("__own_year", year(F.col("__p")))
    hits = ((v == F.col("__value")) & (F.col("__own_year") == F.col("__year")) & (F.col("__salt") == F.col("__copy"))
            & (F.col("__p") > F.col("after")) & (F.col("upto").isNull() | (F.col("__p") <= F.col("upto"))))
    j = at.join(filed, hits, "left").join(F.broadcast(means), "__p")  # one row per period
    te = F.when(F.col("__vn") > 0, (F.col("__vs") + F.col("__g") * F.lit(alpha)) / (F.col("__vn") + F.lit(alpha)))
    return j.withColumn(out, F.coalesce(te, F.col("__g"))).select(*[F.col(f"`{c}`") for c in df.columns], out)


def expanding_target_maps(df: DataFrame, col: str, alpha: float, target: str = TARGET,
                          date_col: str = DATE_COL, period: str = "month") -> DataFrame:
    """Every test period's smoothed target map in one pass (M12 + A4).

    For test period M the map uses all rows of earlier periods.  Rows are
    aggregated by (value, period) once; a window per value (bounded by the
    number of periods) gives cumulative sums, and each (value, period) row
    covers the test periods up to that value's next period -- a range join
    against the period table (one row per period, broadcast).  The global
    mean of earlier periods comes from the same per-period totals.
    Output: (test_month, value, te) for values seen before the test period.
    """
    m = month_col(date_col, period)
    base = df.where(F.col(date_col).isNotNull()).select(
        m.alias("m"), F.col(f"`{col}`").alias("value"), F.col(target).alias("y"))
    per_m = base.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    wm = Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1)  # one row per period
    periods = per_m.select(
        F.col("m").alias("test_month"),
        F.coalesce(F.sum("n").over(wm), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("s").over(wm), F.lit(0)).alias("s_before"))
    vm = (base.where(F.col("value").isNotNull()).groupBy("value", "m")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
    wv = Window.partitionBy("value").orderBy("m")  # <= number of periods per value
    vm = vm.select("value", "m",
                   F.sum("n").over(wv.rowsBetween(Window.unboundedPreceding, 0)).alias("cn"),
                   F.sum("s").over(wv.rowsBetween(Window.unboundedPreceding, 0)).alias("cs"),
                   F.lead("m").over(wv).alias("next_m"))
    cover = (F.col("test_month") > F.col("m")) & (
        F.col("next_m").isNull() | (F.col("test_month") <= F.col("next_m")))
    j = vm.join(F.broadcast(periods), cover)
    g = F.when(F.col("n_before") > 0, F.col("s_before") / F.col("n_before")).otherwise(F.lit(0.5))
    return j.select("test_month", "value",
                    ((F.col("cs") + g * F.lit(alpha)) / (F.col("cn") + F.lit(alpha))).alias("te"))
