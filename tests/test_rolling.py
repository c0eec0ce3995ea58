"""The joint monthly fit against dense solves and single fits; keyed metrics; as-of maps."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens import catalog as c
from orderlens.operators import metrics as met
from orderlens.plans import backtest as bt
from orderlens.plans import models as mdl
from orderlens.plans import rolling as roll

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def design(spark):
    feats = c._new_feats_dated(spark, SF)
    return feats, roll.prepare(feats, c.FC)


@pytest.fixture(scope="module")
def models(design):
    return roll.fit(design[1])


def dense(d, k):
    """The matrix, labels and weights of the model of month index k, from the staged rows."""
    rows = d.rows.where(F.col("m") < int(k)).toPandas()
    x = (np.array(rows["x"].tolist()) - d.mean[k]) / d.std[k]
    t = np.stack([[a[k] for a in rows[f"t_{j}"]] for j in range(d.n_t)], axis=1)
    hot = np.zeros((len(rows), d.n_c))
    for i, slots in enumerate(rows["c"]):
        for s in slots:
            if s >= 0:
                hot[i, s] = 1
    y = rows["y"].to_numpy(float)
    p = y.sum()
    w = np.where(y == 1, len(y) / (2 * p), len(y) / (2 * (len(y) - p)))
    return np.hstack([x, t, hot, np.ones((len(rows), 1))]), y, w, rows


def value(a, y, w, theta):
    z = a @ theta
    return (w * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * theta @ theta


def solve(a, y, w):
    theta = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-a @ theta))
        g = a.T @ (w * (p - y)) + theta
        step = np.linalg.solve(a.T @ (a * (w * p * (1 - p))[:, None]) + np.eye(a.shape[1]), g)
        t = 1.0
        while value(a, y, w, theta - t * step) > value(a, y, w, theta) and t > 1e-8:
            t /= 2
        theta = theta - t * step
    return theta


def test_every_month_is_at_its_optimum(design, models):
    _, d = design
    assert models.left.max() <= 1e-6 and len(d.tests) > 40
    for i in (0, 1, len(d.tests) // 2, len(d.tests) - 1):
        a, y, w, _ = dense(d, d.tests[i])
        best = solve(a, y, w)
        assert value(a, y, w, models.w[i]) <= value(a, y, w, best) * (1 + 1e-8)
        assert np.abs(models.w[i] - best).max() < 1e-5


def test_quasi_newton_reaches_the_same_optimum(design, models):
    _, d = design
    some = np.arange(len(d.tests) - 3, len(d.tests))
    full = roll.objective(d, 1.0, True)
    w, left, _ = roll.quasi_newton(lambda w, which, second="none": full(w, some[which], second), 3, d.size, tol=1e-3)
    assert left.max() <= 1e-3 and np.abs(w - models.w[some]).max() < 1e-3


def test_encodings_by_hand(design):
    feats, d = design
    k = d.tests[len(d.tests) // 2]
    *_, rows = dense(d, k)
    col, alpha = c.TE_COLS[0]
    raw = feats.select("row_id", F.col(f"`{col}`").alias("v"), "buyout_flag", F.date_format("sale_date", "yyyy-MM").alias("m"),
                       mdl.enc.hash_folds(F.col("row_id"), 5).alias("f")).toPandas()
    past = raw[raw["m"] < d.months[k]]
    g = past["buyout_flag"].mean()
    where = {n: i for i, n in enumerate(c.FC.te_cols)}[col]
    by_id = rows.set_index("row_id")
    for r in past.head(60).itertuples():
        others = past[(past["v"] == r.v) & (past["f"] != r.f)]
        want = (others["buyout_flag"].sum() + g * alpha) / (len(others) + alpha) if len(others) else g
        assert by_id.loc[r.row_id, f"t_{where}"][k] == pytest.approx(want, abs=1e-12)
    now = raw[raw["m"] == d.months[k]]
    scored = d.rows.where(F.col("m") == int(k)).toPandas().set_index("row_id")
    for r in now.itertuples():
        seen = past[past["v"] == r.v]
        want = (seen["buyout_flag"].sum() + g * alpha) / (len(seen) + alpha) if len(seen) else g
        assert scored.loc[r.row_id, "u"][where] == pytest.approx(want, abs=1e-12)


def test_five_months_equal_single_fits(spark, design, monkeypatch):
    """Free intercept, as the single fits have; their solver run to the end."""
    feats, d = design
    plain = mdl.logistic
    monkeypatch.setattr(mdl, "logistic", lambda *a, **k: plain(*a, **{**k, "tol": 1e-13, "max_iter": 5000}))
    feats = feats.withColumn("__fold5", mdl.enc.hash_folds(F.col("row_id"), 5))
    joint = roll.fit(d, penalise_intercept=False).scores()
    got = {(r.test_month, r.row_id): r.p for r in joint.collect()}
    for k in d.tests[-5:]:
        month = d.months[k]
        train = feats.where(F.date_format("sale_date", "yyyy-MM") < month)
        test = feats.where(F.date_format("sale_date", "yyyy-MM") == month)
        single = mdl.FullFeatureModel.fit(train, c.FC, fold_col="__fold5").predict_proba(test).collect()
        assert single
        for r in single:
            assert abs(got[month, r.row_id] - r.proba) < 1e-4


def test_backtest_rows_and_metrics(spark, design, models):
    feats, d = design
    scores = models.scores()
    table = scores.toPandas()
    out = {r.test_month: r for r in bt.evaluated(scores, feats).collect()}
    counts = {r.test_month: r for r in bt.expanding_month_counts(feats).collect()}
    assert out.keys() == counts.keys() == {d.months[k] for k in d.tests}
    grid = met.grid(**met.F1_GRID)
    for month, r in out.items():
        own = table[table["test_month"] == month]
        y, p = own["y"].to_numpy(), own["p"].to_numpy()
        assert (r.n_train, r.n_test, len(y)) == (counts[month].n_train, counts[month].n_test, counts[month].n_test)
        pairs = [(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]]
        assert r.test_auc == pytest.approx(np.mean(pairs), abs=1e-12)
        f1 = [2 * ((p >= t) & (y == 1)).sum() / max(1, (p >= t).sum() + y.sum()) for t in grid]
        assert r.test_f1 == pytest.approx(max(f1), abs=1e-12)
        assert r.best_threshold == (grid[int(np.argmax(f1))] if max(f1) > 0 else 0.5)


def test_keyed_metrics_equal_the_single_ones(spark):
    rows = [(k, i % 3 == 0 if k != "one" else True, ((i * 37 + len(str(k))) % 11) / 10) for k in ("a", "b", None, "one") for i in range(60)]
    df = spark.createDataFrame([(k, int(y), p) for k, y, p in rows], "k string, y int, p double")
    df = df.union(spark.createDataFrame([("a", 1, None)], df.schema))  # no score: left out
    got = {r.k: r for r in met.metrics_by(df, ["k"]).collect()}
    assert set(got) == {"a", "b", None, "one"}
    for k, r in got.items():
        own = df.where(F.col("k").eqNullSafe(F.lit(k)) & F.col("p").isNotNull())
        one, best = met.classification_metrics(own).first(), met.best_f1_threshold(own).first()
        for name in ("roc_auc", "pr_auc"):
            assert (r[name] is None) == (one[name] is None) and (r[name] is None or math.isclose(r[name], one[name], rel_tol=1e-12))
        assert (r.best_f1, r.best_threshold, r.n) == (best.best_f1, best.best_threshold, 60)
    assert met.metrics_by(df.limit(0), ["k"]).count() == 0


def test_as_of_map_equals_the_expanding_maps(spark, design):
    feats, _ = design
    col, alpha = c.TE_COLS[0]
    rows = feats.select("row_id", "buyout_flag", "sale_date", F.col(f"`{col}`"))
    at = {r.row_id: r for r in bt.target_map_as_of(rows, col, alpha).withColumn("m", F.date_format("sale_date", "yyyy-MM")).collect()}
    assert len(at) == rows.count()
    wide = {(r.test_month, r.value): r.te for r in bt.expanding_target_maps(rows, col, alpha).collect()}
    met_some = 0
    for r in at.values():
        if (r.m, r[col]) in wide:
            met_some += 1
            assert r.te == pytest.approx(wide[r.m, r[col]], abs=1e-12)
    assert met_some > 500
    kept = bt.target_map_intervals(rows, col)
    assert kept.count() == rows.where(F.col(f"`{col}`").isNotNull()).select(F.date_format("sale_date", "yyyy-MM"), F.col(f"`{col}`")).distinct().count()


def test_second_derivatives_are_summed_by_halves_and_reach_the_driver_once(spark):
    """X'WX of rows in any order equals a plain product; the tasks' sums are one array at the end."""
    rng = np.random.default_rng(5)
    n, models, d_x, n_t, n_cats, d_c = 1_300, 4, 3, 2, 2, 7
    x, h = rng.normal(size=(n, d_x)), rng.random((n, models))
    c = np.stack([rng.integers(-1, 4, n), np.where(rng.random(n) < 0.2, -1, rng.integers(4, 7, n))], axis=1)
    t = [rng.random((n, models)) for _ in range(n_t)]
    until = np.array([0, 5, 700, n])
    got = roll._second(x, c, t, h, until, d_c)
    hot = np.zeros((n, d_c))
    for i in range(n_cats):
        hot[c[:, i] >= 0, c[c[:, i] >= 0, i]] = 1.0
    for k, u in enumerate(until):
        full = np.hstack([x, *[v[:, [k]] for v in t], hot, np.ones((n, 1))])[:u]
        want = full.T @ (full * h[:u, [k]])
        assert np.allclose(got[k], want[np.triu_indices(len(want))], atol=1e-9)
