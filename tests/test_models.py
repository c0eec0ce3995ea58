"""Model fits, persistence and the routed predictor on the smallest scale."""

import math
import tempfile

import pytest
from pyspark.sql import functions as F

from orderlens import catalog as c
from orderlens.operators.contexts import build_contexts
from orderlens.plans import models as mdl
from orderlens.sources.leads import city_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    df = c.with_prior(spark, SF)
    new = df.filter(c.is_new_column())
    ctx = build_contexts(new, city_table(spark, SF))
    feats, fc = c.new_cohort_features(spark, SF)
    m_new = mdl.FullFeatureModel.fit(feats, fc)
    m_ret = mdl.PriorCountModel.fit(df)
    return df, ctx, m_new, m_ret


def test_prior_model_recovers_direction(spark, fitted):
    _, _, _, m_ret = fitted
    grid = mdl.calibration_points(m_ret, spark, n=5).orderBy("prior_orders").collect()
    assert len(grid) == 5 and all(0 <= r["proba"] <= 1 for r in grid)


def test_predictor_round_trip_and_one_row_per_input(spark, fitted):
    df, ctx, m_new, m_ret = fitted
    d = tempfile.mkdtemp(prefix="orderlens-model-")
    mdl.OrderOutcomePredictor.save(d, ctx, m_new, m_ret, 0.42, "2000-12", "2001-01")
    pred = mdl.OrderOutcomePredictor(spark, d)
    assert pred.threshold == 0.42
    out = pred.predict(df)
    assert out.count() == df.count() and out.select("row_id").distinct().count() == df.count()
    direct = mdl.route_and_score(df, c.load_feature_config(), ctx, m_new, m_ret, 0.42)
    a = {r["row_id"]: r["proba"] for r in out.collect()}
    b = {r["row_id"]: r["proba"] for r in direct.collect()}
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9, abs_tol=1e-12) for k in a)
    assert out.where((F.col("proba") >= 0.42) != (F.col("decision") == 1)).count() == 0


def test_encoder_names_cover_vector(spark, fitted):
    _, _, m_new, _ = fitted
    feats, fc = c.new_cohort_features(spark, SF)
    v = m_new.encoder.transform(feats).select("features").first()["features"]
    assert v.size == len(m_new.encoder.names)
    # NULL and unseen categories encode as an all-zero block
    col = fc.cat_cols[0]
    odd = feats.limit(2).withColumn(col, F.when(F.col("row_id") >= 0, F.lit(None).cast("string")))
    odd = odd.union(feats.limit(1).withColumn(col, F.lit("never-seen")))
    n_cat = sum(1 for n in m_new.encoder.names if m_new.encoder.group_map[n] == col)
    for r in m_new.encoder.transform(odd).select("features").collect():
        assert all(x == 0 for x in r["features"].toArray()[:n_cat])


def test_logistic_recovers_planted_coefficients(spark):
    from pyspark.ml.feature import VectorAssembler
    n = 40000
    df = (spark.range(n).select(((F.rand(3) - 0.5) * 4).alias("x"), F.rand(4).alias("u"))
          .withColumn("buyout_flag", (F.col("u") < 1 / (1 + F.exp(-(0.5 + 1.5 * F.col("x"))))).cast("int")))
    d = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    lr = mdl.logistic(None, float(n)).fit(d)
    assert abs(lr.coefficients[0] - 1.5) < 0.1 and abs(lr.intercept - 0.5) < 0.1


def test_rows_only_queries_invariants(spark, fitted):
    df, _, _, m_ret = fitted
    # M1: one probability per row, monotone in the prior count (positive slope here)
    p = m_ret.predict_proba(df)
    assert p.count() == df.count() and p.select("row_id").distinct().count() == df.count()
    curve = [r["proba"] for r in mdl.calibration_points(m_ret, spark, n=20).orderBy("prior_orders").collect()]
    slope = m_ret.lr.coefficients[0]
    assert all((b - a) * slope >= -1e-15 for a, b in zip(curve, curve[1:]))


def test_backtest_loop_with_constant_scorer(spark):
    from orderlens.plans import backtest as bt
    feats, _ = c.new_cohort_features(spark, SF)
    feats = c.drop_missing_dates(feats)

    def constant(train, test):
        return test.select("row_id", F.lit(0.5).alias("proba"))
    res = {r["test_month"]: r for r in bt.cumulative_months_loop(feats, constant, period="year").collect()}
    counts = {r["test_month"]: r for r in bt.expanding_month_counts(feats, period="year").collect()}
    assert res.keys() == counts.keys() and len(res) > 0
    for m, r in res.items():
        assert r["test_auc"] == 0.5 and r["n_train"] == counts[m]["n_train"]
        assert r["n_test"] == counts[m]["n_test"]
