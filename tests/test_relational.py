"""Cleaning, the prior-order window, encodings, metrics and profiles on
hand-written rows, against brute-force Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from orderlens.operators import encode as enc
from orderlens.operators import metrics as met
from orderlens.operators.clean import clean_raw, prior_order_count
from orderlens.operators.profile import drift_summary, feature_drift, numeric_histogram
from orderlens.schema import DEAL_COUNT_COL


def brute_prior(rows):
    """Plain statement of the prior-count rule (rows: id, contact, created, snap)."""
    out = {}
    by = {}
    for r in rows:
        if r[1] is not None:
            by.setdefault(r[1], []).append(r)
        else:
            out[r[0]] = r[3]
    for c, rs in by.items():
        rs = sorted(rs, key=lambda r: (r[2] is None, r[2] if r[2] is not None else 0, r[0]))
        last = [r[3] for r in rs if r[3] is not None]
        last = last[-1] if last else None
        total = len(rs)
        for rank, r in enumerate(rs):
            out[r[0]] = float(rank) if last is not None and last < total else (
                None if last is None else last - total + 1 + rank)
    return out


def test_prior_count_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        contact = None if i % 37 == 0 else rnd.randint(0, 30)
        created = None if i % 23 == 0 else float(rnd.randint(0, 20) * 43200)  # ties + day buckets
        snap = float(rnd.choice([0, 1, 3, 8, 20]))
        rows.append((i, contact, created, snap))
    # one hot contact holding a third of the rows
    rows += [(1000 + j, 999, float(j % 50) * 3600.0, 5.0) for j in range(200)]
    rows += [(2000 + j, 998, None, 3.0) for j in range(40)]  # hot contact without times
    df = spark.createDataFrame(rows, f"row_id long, contact_id long, lead_created_at double, `{DEAL_COUNT_COL}` double")
    want = brute_prior(rows)
    got = {r["row_id"]: r[DEAL_COUNT_COL] for r in prior_order_count(df).collect()}
    assert got == want
    # force the nested-bucket path (day -> hour -> minute -> second)
    got = {r["row_id"]: r[DEAL_COUNT_COL] for r in prior_order_count(df).collect()}
    assert got == want


def test_clean_raw_rules(spark):
    df = spark.createDataFrame(
        [(1, True, "true", "1.5", "2024-01-02 00:00:00", None, "x"),
         (2, None, "False", "bad", "not a date", "3", "y"),
         (3, False, "True", None, None, "2", "z")],
        f"row_id long, outcome_unknown boolean, buyout_flag string, lead_price string, "
        f"sale_date string, `{DEAL_COUNT_COL}` string, lead_status_id string")
    out = {r["row_id"]: r for r in clean_raw(df, "yyyy-MM-dd HH:mm:ss").collect()}
    assert set(out) == {2, 3}                      # true outcome_unknown dropped, NULL kept
    assert out[2]["buyout_flag"] == 0 and out[3]["buyout_flag"] == 1
    assert out[2]["lead_price"] is None and out[2]["sale_date"] is None
    assert out[3][DEAL_COUNT_COL] == 2.0 and "lead_status_id" not in out[2].asDict()
    bad = spark.createDataFrame([(1, "maybe")], "row_id long, buyout_flag string")
    with pytest.raises(Exception):
        clean_raw(bad).collect()


def test_oof_never_uses_own_fold(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", "c", None]), rnd.randint(0, 1), i % 4) for i in range(300)]
    rows.append((999, "only_here", 1, 2))          # category living in one fold only
    df = spark.createDataFrame(rows, "row_id long, v string, y int, fold int")
    g = sum(r[2] for r in rows) / len(rows)
    got = {r["row_id"]: r["te"] for r in enc.oof_target_encode(df, "v", "y", "fold", 10, g, "te").collect()}
    for rid, v, _, f in rows:
        if v is None:
            assert got[rid] == g
            continue
        other = [r for r in rows if r[1] == v and r[3] != f]
        want = g if not other else (sum(r[2] for r in other) + g * 10) / (len(other) + 10)
        assert math.isclose(got[rid], want, rel_tol=1e-12)
    assert got[999] == g


def test_target_map_unseen_and_null(spark):
    tr = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "v string, y int")
    g = enc.global_mean(tr, "y")
    m = enc.target_map(tr, "v", "y", 2, g)
    te = spark.createDataFrame([(0, "a"), (1, "zzz"), (2, None)], "row_id int, v string")
    got = {r["row_id"]: r["te"] for r in enc.apply_target_map(te, "v", m, g, "te").collect()}
    assert math.isclose(got[0], (1 + g * 2) / 4) and got[1] == g and got[2] == g


def brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    s = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def brute_ap(ys, ps):
    P = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(ps), reverse=True):
        tp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def brute_best_f1(ys, ps):
    best, bt = 0.0, 0.5
    for t in met.grid(0.05, 0.81, 0.01):
        tp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 0)
        fn = sum(1 for y, p in zip(ys, ps) if p < t and y == 1)
        f1 = 2 * tp / (2 * tp + fp + fn) if (2 * tp + fp + fn) else 0.0
        if f1 > best:
            best, bt = f1, t
    return best, bt


def test_ranking_and_grid_metrics(spark):
    rnd = random.Random(11)
    ys = [rnd.randint(0, 1) for _ in range(500)]
    ps = [round(rnd.random(), 2) for _ in range(500)]   # many ties, some exactly on grid points
    df = spark.createDataFrame(list(zip(ys, ps)), "y int, p double")
    row = met.classification_metrics(df, 0.5).first()
    assert math.isclose(row["roc_auc"], brute_auc(ys, ps), rel_tol=1e-12)
    assert math.isclose(row["pr_auc"], brute_ap(ys, ps), rel_tol=1e-9)
    flipped = df.select("y", (1 - F.col("p")).alias("p"))
    assert math.isclose(met.classification_metrics(flipped, 0.5).first()["roc_auc"] + row["roc_auc"], 1.0)
    b = met.best_f1_threshold(df).first()
    want = brute_best_f1(ys, ps)
    assert math.isclose(b["best_f1"], want[0]) and b["best_threshold"] == want[1]


def test_metrics_one_class_and_no_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, p double")
    row = met.classification_metrics(df, 0.5).first()
    assert row["roc_auc"] is None and row["mcc"] is None and row["pr_auc"] is None
    assert row["precision"] == 0.0 and row["f1"] == 0.0 and row["balanced_accuracy"] == 0.0
    b = met.best_f1_threshold(spark.createDataFrame([(0, 0.9), (0, 0.1)], "y int, p double")).first()
    assert (b["best_f1"], b["best_threshold"]) == (0.0, 0.5)


def test_histogram_totals_and_edges(spark):
    vals = [0.0, 1.0, 1.5, 2.0, 3.0, 3.0, None]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "x double, buyout_flag int")
    h = numeric_histogram(df, "x", bins=3).orderBy("bin").collect()
    assert sum(r["n_total"] for r in h) == 6            # totals = non-null rows
    assert [r["n_total"] for r in h] == [1, 2, 3]       # edges are left-closed; last bin closed
    one = numeric_histogram(spark.createDataFrame([(5.0, 1)], "x double, buyout_flag int"), "x", bins=2)
    assert [(r["lo"], r["hi"]) for r in one.orderBy("bin").collect()] == [(4.5, 5.0), (5.0, 5.5)]


def test_drift_null_dates_and_cutoff_row(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "a", 1), ("2023-12-31", "a", 0), (None, "b", 1), ("2024-02-01", None, 1)],
        "d string, f string, buyout_flag int").withColumn("sale_date", F.to_timestamp_ntz("d"))
    rows = {r["category"]: r for r in feature_drift(df, "f", "2024-01-01").collect()}
    assert rows["a"]["pre_share"] == 1.0 and rows["a"]["post_share"] == 0.5   # cutoff row is post
    assert rows["b"]["pre_share"] == 0.0 and rows["b"]["pre_rate"] is None      # null date in neither
    s = {r["label"]: r for r in drift_summary(df, [{"label": "sh", "column": "f", "agg": "share",
                                                    "value": "a"}], "2024-01-01").collect()}
    assert s["sh"]["post"] == 1.0                                              # null text leaves denominator


def test_expanding_target_maps_equal_per_month_fits(spark):
    from orderlens.plans.backtest import expanding_target_maps
    rnd = random.Random(9)
    rows = [(f"2024-0{rnd.randint(1, 5)}-1{rnd.randint(0, 9)}", rnd.choice(["a", "b", "c", None]),
             rnd.randint(0, 1)) for _ in range(300)]
    df = (spark.createDataFrame(rows, "d string, v string, buyout_flag int")
               .withColumn("sale_date", F.to_timestamp_ntz("d")))
    got = {(r["test_month"], r["value"]): r["te"] for r in expanding_target_maps(df, "v", 10).collect()}
    months = sorted({d[:7] for d, _, _ in rows})
    want = {}
    for m in months[1:]:
        tr = [(v, y) for d, v, y in rows if d[:7] < m]
        g = sum(y for _, y in tr) / len(tr)
        for v in {v for v, _ in tr if v is not None}:
            ys = [y for vv, y in tr if vv == v]
            want[(m, v)] = (sum(ys) + g * 10) / (len(ys) + 10)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)


def test_feature_overview_dispatch_and_sweep_errors(spark):
    from orderlens.operators.profile import feature_overview
    df = spark.createDataFrame([(float(i), str(i % 3), i % 2) for i in range(40)],
                               "x double, c string, buyout_flag int")
    assert "bin" in feature_overview(df, "x").columns
    assert "category" in feature_overview(df, "c").columns
    few = spark.createDataFrame([(float(i % 4), i % 2) for i in range(40)], "x double, buyout_flag int")
    assert "category" in feature_overview(few, "x").columns       # <= 15 distinct -> categories
    flat = spark.createDataFrame([(1, 0.99), (0, 0.99)], "y int, p double")
    with pytest.raises(ValueError):
        met.best_of_sweep(met.threshold_sweep(flat))
    ok = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.6), (0, 0.4)], "y int, p double")
    t, f1 = met.best_of_sweep(met.threshold_sweep(ok))
    assert f1 == 1.0 and t == met.grid(0.05, 0.96, 0.01)[35] and t > 0.4   # grid value just above 0.4


def test_multi_profile_equals_single_profiles(spark):
    from orderlens.operators.profile import category_profile, category_profiles
    rnd = random.Random(4)
    rows = [(f"c{rnd.randint(0, 39)}", rnd.choice(["x", "y", None]), rnd.randint(0, 1)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a string, b string, buyout_flag int")
    many = category_profiles(df, ["a", "b"], known_orders={"b": ["y"]})
    for col, known in (("a", None), ("b", ["y"])):
        one = category_profile(df, col, known_order=known)
        got = sorted(tuple(r) for r in many.where(F.col("feature") == col).drop("feature").collect())
        want = sorted(tuple(r) for r in one.select("category", "n_pos", "n_neg", "n_total", "rate",
                                                   "position").collect())
        assert got == want
    assert many.where(F.col("feature") == "a").count() == 40       # every category is kept
    assert category_profiles(df, ["a"], top_n=5).count() == 5


def test_all_scores_equal_and_profile_totals(spark):
    from orderlens.operators.profile import category_profile
    df = spark.createDataFrame([(i % 3 == 0 and 1 or 0, 0.37) for i in range(90)], "y int, p double")
    row = met.classification_metrics(df, 0.5).first()
    assert row["roc_auc"] == 0.5 and row["tp"] == 0 and row["tn"] == 60
    assert math.isclose(row["pr_auc"], 30 / 90)
    rnd = random.Random(8)
    rows = [(rnd.choice(["a", "b", "c", None]), rnd.randint(0, 1)) for _ in range(500)]
    prof = category_profile(spark.createDataFrame(rows, "c string, buyout_flag int"), "c")
    assert prof.agg(F.sum("n_total")).first()[0] == sum(1 for c, _ in rows if c is not None)
    assert sorted(r["position"] for r in prof.collect()) == [0, 1, 2]
