"""Profiles behind the analysis charts (A6-A14, O3): every one is a grouped
aggregate over the whole table; only the small aggregated result is ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.functions.ops import Val, is_numeric, plain_text, to_double
from orderlens.operators.ranking import ranked
from orderlens.schema import DATE_COL, DEAL_COUNT_COL, NAN_TOKEN, TARGET

BIG = 1 << 30


def category_order(col: str, known: list[str] | None) -> Column:
    """O3 sort key: known order first (present ones), the rest after."""
    if not known:
        return F.lit(BIG)
    pos = F.array_position(F.array(*[F.lit(k) for k in known]), F.col(col))
    return F.coalesce(F.nullif(pos, F.lit(0)), F.lit(BIG)).cast("long")


def category_profile(df: DataFrame, col: str, target: str = TARGET, top_n: int | None = None,
                     known_order: list[str] | None = None) -> DataFrame:
    """Per non-null category: positives, negatives, total (non-null
    targets), rate (0 when total is 0), ``position`` in display order.

    All categories are kept; only an explicit ``top_n`` keeps the most frequent
    ones through a semi join against that n-row table.
    """
    c = F.col(f"`{col}`")
    work = df.select(c.alias("category"), F.col(target).alias("y"))
    if top_n is not None:
        top = (work.where(F.col("category").isNotNull()).groupBy("category").count()
                   .orderBy(F.desc("count"), F.asc("category")).limit(top_n).select("category"))
        work = work.join(F.broadcast(top), "category", "left_semi")
    prof = (work.where(F.col("category").isNotNull())
                .groupBy("category")
                .agg(F.sum("y").cast("long").alias("n_pos"),
                     F.count("y").alias("n_total")))
    prof = prof.select(
        F.col("category").cast("string").alias("category"),
        F.col("n_pos"),
        (F.col("n_total") - F.col("n_pos")).alias("n_neg"),
        F.col("n_total"),
        F.when(F.col("n_total") > 0, F.col("n_pos") / F.col("n_total")).otherwise(F.lit(0.0))
         .alias("rate"))
    shown = [category_order("category", known_order), F.desc("n_total"), F.asc("category")]
    return ranked(prof, shown, "position").withColumn("position", (F.col("position") - 1).cast("int"))


def numeric_histogram(df: DataFrame, col: str, target: str = TARGET, bins: int = 30,
                      xlim: tuple | None = None) -> DataFrame:
    """Equal-width bins over the non-NULL values (optionally inside an
    inclusive range), left-closed with the last bin closed; per bin total,
    positives, negatives, rate (NULL when empty); ``mean_value`` is the mean
    of the values used.  Edges follow numpy (``lo + i*step``, last = hi;
    a zero-width range is widened by 0.5 on each side)."""
    x = to_double(Val(F.col(f"`{col}`"), df.schema[col].dataType))
    work = df.select(x.alias("v"), F.col(target).alias("y")).where(F.col("v").isNotNull())
    if xlim is not None:
        lo0, hi0 = xlim
        if lo0 is None or hi0 is None:
            mn, mx = work.agg(F.min("v"), F.max("v")).first()
            lo0 = mn if lo0 is None else lo0
            hi0 = mx if hi0 is None else hi0
        work = work.where((F.col("v") >= lo0) & (F.col("v") <= hi0))
        lo, hi, mean = lo0, hi0, work.agg(F.avg("v")).first()[0]
    else:
        lo, hi, mean = work.agg(F.min("v"), F.max("v"), F.avg("v")).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, n_total long, n_pos long, "
                                         "n_neg long, rate double, mean_value double")
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))

    v = F.col("v")
    b0 = F.least(F.greatest(F.floor((v - F.lit(lo)) / F.lit(step)), F.lit(0)), F.lit(bins - 1))
    b1 = F.when((b0 > 0) & (v < edge(b0)), b0 - 1).otherwise(b0)
    b = F.when((b1 < bins - 1) & (v >= edge(b1 + 1)), b1 + 1).otherwise(b1).cast("int")
    counts = (work.groupBy(b.alias("bin"))
                  .agg(F.count(F.lit(1)).alias("n_total"), F.sum("y").cast("long").alias("n_pos")))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    j = grid.join(F.broadcast(counts), "bin", "left")  # <= bins rows
    n_total = F.coalesce(F.col("n_total"), F.lit(0)).cast("long")
    n_pos = F.coalesce(F.col("n_pos"), F.lit(0)).cast("long")
    return j.select(
        "bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"),
        n_total.alias("n_total"), n_pos.alias("n_pos"), (n_total - n_pos).alias("n_neg"),
        F.when(n_total > 0, n_pos / n_total).alias("rate"),
        F.lit(mean).cast("double").alias("mean_value"))


def month_timeline(df: DataFrame, is_new: Column, date_col: str = DATE_COL,
                   target: str = TARGET) -> DataFrame:
    """Per month and cohort: orders and buyout rate (rows with a date)."""
    return (df.where(F.col(date_col).isNotNull())
              .groupBy(F.date_format(F.col(date_col), "yyyy-MM").alias("month"), is_new.alias("is_new"))
              .agg(F.count(F.lit(1)).alias("orders"),
                   (F.sum(target) / F.count(F.lit(1))).alias("buyout_rate")))


def _text_or_nan(df: DataFrame, col: str) -> Column:
    return F.coalesce(plain_text(Val(F.col(f"`{col}`"), df.schema[col].dataType)), F.lit(NAN_TOKEN))


def feature_drift(df: DataFrame, feature: str, cutoff: str, target: str = TARGET,
                  date_col: str = DATE_COL, max_categories: int = 8,
                  known_order: list[str] | None = None) -> DataFrame:
    """Top categories (over all rows, NULL as '__NaN__'): share and rate
    before / on-or-after the cutoff; NULL dates are in neither period."""
    d = F.col(date_col)
    cut = F.to_timestamp_ntz(F.lit(cutoff))
    pre = d < cut
    post = d >= cut
    v = _text_or_nan(df, feature)
    y = F.col(target)
    ind = lambda c: F.when(c, 1).otherwise(0)
    g = (df.groupBy(v.alias("category"))
           .agg(F.count(F.lit(1)).alias("total"),
                F.sum(ind(pre)).alias("n_pre"), F.sum(ind(post)).alias("n_post"),
                F.sum(F.when(pre, y)).alias("pos_pre"), F.sum(F.when(post, y)).alias("pos_post")))
    tot = g.agg(F.sum("n_pre"), F.sum("n_post")).first()
    n_pre, n_post = int(tot[0] or 0), int(tot[1] or 0)
    top = g.orderBy(F.desc("total"), F.asc("category")).limit(max_categories)
    share = lambda n, t: (F.col(n) / F.lit(t)) if t else F.lit(None).cast("double")
    out = top.select(
        "category", "total",
        share("n_pre", n_pre).alias("pre_share"), share("n_post", n_post).alias("post_share"),
        F.when(F.col("n_pre") > 0, F.col("pos_pre") / F.col("n_pre")).alias("pre_rate"),
        F.when(F.col("n_post") > 0, F.col("pos_post") / F.col("n_post")).alias("post_rate"))
    w = Window.orderBy(category_order("category", known_order), F.desc("total"), F.asc("category"))
    return out.withColumn("position", (F.row_number().over(w) - 1).cast("int")).drop("total")


def drift_summary(df: DataFrame, spec: list[dict], cutoff: str, date_col: str = DATE_COL,
                  target: str = TARGET) -> DataFrame:
    """A10: one aggregate pass for all rows of the spec, unpivoted to
    (label, pre, post).  ``mean`` of a number; ``share`` of rows equal to a
    value (NULL text leaves the denominator); ``rate`` of the target,
    optionally where ``column == value``."""
    d = F.col(date_col)
    cut = F.to_timestamp_ntz(F.lit(cutoff))
    periods = {"pre": d < cut, "post": d >= cut}
    aggs = []
    for i, row in enumerate(spec):
        agg = row["agg"]
        for pname, pc in periods.items():
            if agg == "mean":
                x = to_double(Val(F.col(f"`{row['column']}`"), df.schema[row["column"]].dataType))
                e = F.avg(F.when(pc, x))
            elif agg == "share":
                s = plain_text(Val(F.col(f"`{row['column']}`"), df.schema[row["column"]].dataType))
                e = F.avg(F.when(pc & s.isNotNull(), (s == F.lit(str(row["value"]))).cast("int")))
            elif agg == "rate":
                tcol = row.get("target_col", target)
                if "value" in row:
                    s = plain_text(Val(F.col(f"`{row['column']}`"), df.schema[row["column"]].dataType))
                    cond = pc & F.coalesce(s == F.lit(str(row["value"])), F.lit(False))
                    e = F.avg(F.when(cond, F.col(tcol)))
                else:
                    e = F.avg(F.when(pc, F.col(row.get("column") or tcol)))
            else:
                raise ValueError(f"unknown agg: {agg!r}")
            aggs.append(e.alias(f"{pname}_{i}"))
    one = df.agg(*aggs)
    stack = ", ".join(f"{_sql_str(r['label'])}, pre_{i}, post_{i}" for i, r in enumerate(spec))
    return one.selectExpr(f"stack({len(spec)}, {stack}) AS (label, pre, post)")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rate_by_capped_count(df: DataFrame, capped: Column, target: str = TARGET) -> DataFrame:
    """Buyout rate, positives and rows per capped prior-order count."""
    return (df.groupBy(capped.alias("deals"))
              .agg((F.sum(target) / F.count(F.lit(1))).alias("buyout_rate"),
                   F.sum(target).cast("long").alias("n_buyout"),
                   F.count(F.lit(1)).alias("n_total")))


def value_counts_top(df: DataFrame, col: str, k: int) -> DataFrame:
    """A13 + A14: the k most frequent non-NULL values with their count and
    rank (ties broken by value), the number of distinct values (NULL
    counted as one) and the rows kept by a semi join on the top k (J4)."""
    v = F.col(f"`{col}`")
    counts = df.groupBy(v.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    n_distinct = counts.count()
    top = (counts.where(F.col("category").isNotNull())
                 .orderBy(F.desc("n"), F.asc("category")).limit(k))
    # windows over the k-row top table; the rows a semi join on it keeps are the sum of its counts
    return top.select(
        "category", "n", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("category"))).cast("int").alias("rank"),
        F.lit(n_distinct).cast("long").alias("n_distinct"),
        F.sum("n").over(Window.partitionBy(F.lit(0))).cast("long").alias("rows_in_top"))


def is_numeric_feature(df: DataFrame, col: str, min_distinct: int = 15) -> bool:
    """A numeric column with more than 15 distinct non-NULL values is
    profiled as a histogram, anything else by category (one aggregate)."""
    if not is_numeric(df.schema[col].dataType):
        return False
    n = df.agg(F.count_distinct(F.col(f"`{col}`"))).first()[0]
    return n > min_distinct


def feature_overview(df: DataFrame, col: str, target: str = TARGET, bins: int = 30,
                     known_order: list[str] | None = None, top_n: int | None = None) -> DataFrame:
    """Dispatch to the histogram (A7) or the category profile."""
    if is_numeric_feature(df, col):
        return numeric_histogram(df, col, target, bins)
    return category_profile(df, col, target, top_n=top_n, known_order=known_order)


def category_profiles(df: DataFrame, cols: list[str], target: str = TARGET,
                      known_orders: dict | None = None, top_n: int | None = None) -> DataFrame:
    """A6 for several features in one pass (long form): rows are exploded to
    (feature, category) and aggregated once; the display order is a distributed
    rank of the aggregated table, the cut to an explicit ``top_n`` a rank limit."""
    known_orders = known_orders or {}
    items = F.array(*[F.struct(F.lit(c).alias("feature"),
                               plain_text(Val(F.col(f"`{c}`"), df.schema[c].dataType)).alias("category"))
                      for c in cols])
    long = df.select(F.col(target).alias("y"), F.explode(items).alias("kv")).select("y", "kv.*")
    agg = (long.groupBy("feature", "category")
               .agg(F.count(F.lit(1)).alias("rows"), F.sum("y").cast("long").alias("n_pos"),
                    F.count("y").alias("n_total")))
    agg = agg.where(F.col("category").isNotNull())
    if top_n is not None:
        top = Window.partitionBy("feature").orderBy(F.desc("rows"), F.asc("category"))
        agg = agg.withColumn("__r", F.row_number().over(top)).where(F.col("__r") <= top_n)
    known_pos = F.lit(BIG).cast("long")
    for f, known in known_orders.items():
        pos = F.array_position(F.array(*[F.lit(k) for k in known]), F.col("category"))
        known_pos = F.when(F.col("feature") == f, F.coalesce(F.nullif(pos, F.lit(0)), F.lit(BIG)).cast("long")) \
                     .otherwise(known_pos)
    agg = ranked(agg, [known_pos, F.desc("n_total"), F.asc("category")], "position", ["feature"])
    return agg.select(
        "feature", "category", "n_pos", (F.col("n_total") - F.col("n_pos")).alias("n_neg"), "n_total",
        F.when(F.col("n_total") > 0, F.col("n_pos") / F.col("n_total")).otherwise(F.lit(0.0)).alias("rate"),
        (F.col("position") - 1).cast("int").alias("position"))
