"""Distributed ranks and running sums, exact folds, ordered statistics and heavy lookups."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators import encode as enc
from orderlens.operators import lookups
from orderlens.operators.clean import prior_order_count
from orderlens.operators.profile import category_profile
from orderlens.operators.ranking import ranked, running_sums
from orderlens.schema import DEAL_COUNT_COL


def rows_by_task(df):
    got = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return [r["n"] for r in got]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_running_sums_equal_a_window(spark, parts):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "a", "a", "a", "b", "c"]), rng.randrange(5), i, rng.choice([None, 1, -2, 7])) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t int, i long, v int")
    got = running_sums(df, ["k"], [F.desc("t"), "i"], {"total": F.col("v"), "n": F.lit(1).cast("long")}, parts)
    w = Window.partitionBy("k").orderBy(F.desc("t"), "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"total": F.sum("v").over(w), "n": F.count(F.lit(1)).over(w)})
    assert got.columns == want.columns
    assert sorted(got.collect(), key=lambda r: r["i"]) == sorted(want.collect(), key=lambda r: r["i"])


def test_ranks_without_keys_and_of_nothing(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    assert all(r["r"] == r["x"] + 1 for r in ranked(df, ["x"], "r", parts=7).collect())
    assert ranked(df.limit(0), ["x"], "r", parts=7).count() == 0


def test_one_group_spreads_over_tasks(spark):
    """A contact with all rows in one second: the rows that a task ranks stay near the mean."""
    df = spark.range(1_000_000).select(F.lit(1).alias("contact"), F.lit(5.0).alias("second"), "id")
    out = ranked(df, ["second", "id"], "r", ["contact"], parts=16)
    tasks = rows_by_task(out)
    assert sum(tasks) == 1_000_000 and len(tasks) > 3 and max(tasks) <= 3 * sum(tasks) / len(tasks)
    assert out.where("r <> id + 1").isEmpty()


def test_prior_counts_of_one_second_spread(spark):
    df = spark.range(400_000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 4 > 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("contact_id"),
                                     F.lit(1000.0).alias("lead_created_at"), F.lit(1.0).alias(DEAL_COUNT_COL))
    out = prior_order_count(df)
    hot = out.where("contact_id = 7")
    assert hot.agg(F.min(f"`{DEAL_COUNT_COL}`"), F.max(f"`{DEAL_COUNT_COL}`"), F.countDistinct(f"`{DEAL_COUNT_COL}`")).first()[:] == (0, 299_999, 300_000)
    at = running_sums(df.where("contact_id is not null"), ["contact_id"], ["lead_created_at", "row_id"], {"n": F.lit(1)}, 16)
    tasks = rows_by_task(at)
    assert max(tasks) <= 3 * sum(tasks) / len(tasks) and len(tasks) > 3


def test_profile_of_a_million_categories(spark):
    df = spark.range(1_000_000).select(F.col("id").cast("string").alias("c"), (F.col("id") % 2).cast("int").alias("buyout_flag"))
    out = category_profile(df, "c")
    tasks = rows_by_task(out)
    assert sum(tasks) == 1_000_000 and max(tasks) <= 2 * sum(tasks) / len(tasks)
    assert out.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first()[:] == (0, 999_999, 1_000_000)


def test_folds_differ_by_one_at_most(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([0, 0, 0, 1, None])) for i in range(997)]
    df = spark.createDataFrame(rows, "row_id long, y int")
    out = enc.stratified_folds(df, "y", 5)
    got = out.collect()
    assert sorted(r["row_id"] for r in got) == list(range(997)) and out.columns == ["row_id", "y", "fold"]
    sizes = Counter((r["y"], r["fold"]) for r in got)
    for y in (0, 1, None):
        own = [sizes[y, f] for f in range(5)]
        assert max(own) - min(own) <= 1
    whole = Counter(r["fold"] for r in got)
    assert max(whole.values()) - min(whole.values()) <= 1
    assert {r["row_id"]: r["fold"] for r in got} == {r["row_id"]: r["fold"] for r in enc.stratified_folds(df.repartition(7), "y", 5).collect()}
    assert {r["row_id"]: r["fold"] for r in got} != {r["row_id"]: r["fold"] for r in enc.stratified_folds(df, "y", 5, seed=1).collect()}


def test_ordered_statistics_by_hand(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", None]), rng.randrange(2)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, c string, buyout_flag int")
    out = enc.ordered_target_statistics(df, ["c"], "buyout_flag", 3.0, 0.4, ["o"], [F.desc("row_id")])
    seen = defaultdict(lambda: [0, 0])
    want = {}
    for i, v, y in reversed(rows):
        s, n = seen[v]
        want[i] = (s + 0.4 * 3.0) / (n + 3.0)
        seen[v] = [s + y, n + 1]
    assert {r["row_id"]: r["o"] for r in out.collect()} == pytest.approx(want)
    seeded = enc.ordered_target_statistics(df, ["c"], "buyout_flag", 3.0, 0.4, ["o"])
    assert seeded.count() == 200 and seeded.where("abs(o - 0.4) < 1e-12").count() >= 3  # the first of each value


def test_heavy_values_and_spread_lookup(spark):
    """One category with 60 % of the rows and one third NULL: results as without the split, rows spread."""
    n = 200_000
    v = F.when(F.col("id") % 10 < 6, F.lit("hot")).when(F.col("id") % 10 < 9, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id")))
    df = spark.range(n).select(F.col("id").alias("row_id"), v.alias("c"), (F.col("id") % 3 == 0).cast("int").alias("buyout_flag"), (F.col("id") % 5).cast("int").alias("fold"))
    heavy = lookups.heavy_values(df, ["c"])["c"]
    assert heavy == ["hot"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = enc.oof_target_encode(df, "c", "buyout_flag", "fold", 5.0, 0.3, "o")
        split = enc.oof_target_encode(df, "c", "buyout_flag", "fold", 5.0, 0.3, "o", heavy)
        assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
        tasks = rows_by_task(split)
        assert sum(tasks) == n and max(tasks) <= 2 * n / 8
        tmap = enc.target_map(df, "c", "buyout_flag", 5.0, 0.3)
        one = enc.apply_target_map(df, "c", tmap, 0.3, "o")
        two = enc.apply_target_map(df, "c", tmap, 0.3, "o", heavy)
        assert two.exceptAll(one).isEmpty() and max(rows_by_task(two)) <= 2 * n / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert lookups.heavy_values(df.limit(0), ["c"]) == {"c": []}


def test_prior_counts_move_only_the_columns_they_need(spark):
    """No exchange of the result's plan holds a column that the reader did not ask for; rows that
    share contact, time and id get successive counts, NULL contacts keep their value."""
    import io
    from contextlib import redirect_stdout

    rows = [(1, 7, 100.0, 9.0, "a wide text"), (2, 7, None, 9.0, "b"), (3, 7, float("nan"), 9.0, "c"), (4, None, 5.0, 4.0, "d"), (5, 8, 1.0, None, "e")]
    schema = "row_id long, contact_id long, lead_created_at double, `contact_Число сделок` double, cart string"
    out = prior_order_count(spark.createDataFrame(rows, schema))
    got = {r[0]: r[3] for r in out.collect()}
    assert got == {1: 7.0, 2: 8.0, 3: 9.0, 4: 4.0, 5: None}
    text = io.StringIO()
    with redirect_stdout(text):
        out.select("row_id", "`contact_Число сделок`").explain("formatted")
    assert not [part for part in text.getvalue().split("\n\n") if "Exchange" in part and "cart" in part]
    twice = spark.createDataFrame(rows[:2] * 2, schema)
    assert sorted(r[3] for r in prior_order_count(twice).collect()) == [6.0, 7.0, 8.0, 9.0]
