"""Encoder and models as pipeline stages, saved and loaded; boosted trees."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from orderlens import catalog as c
from orderlens.plans import estimators as est
from orderlens.plans import models as mdl
from orderlens.plans.features import FeatureColumns, Role

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    feats, fc = c.new_cohort_features(spark, SF)
    return feats.withColumn("fold", mdl.enc.hash_folds(F.col("row_id"), 5)), fc


def probabilities(df):
    return {r["row_id"]: r["p"] for r in df.select("row_id", mdl.positive_proba(df).alias("p")).collect()}


def test_pipeline_equals_the_model_and_survives_saving(spark, rows, tmp_path):
    df, fc = rows
    fitted = Pipeline(stages=[est.OrderEncoder.of(fc), est.BalancedLogistic()]).fit(df)
    plain = mdl.FullFeatureModel.fit(df, fc, fold_col="fold")
    new = df.drop("fold")  # rows to score have no fold
    want = {r["row_id"]: r["proba"] for r in plain.predict_proba(new).collect()}
    got = probabilities(fitted.transform(new))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert set(fitted.transform(new).columns) == {*new.columns, "features", "rawPrediction", "probability", "prediction"}
    fitted.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert probabilities(loaded.transform(new)) == got
    assert probabilities(loaded.transform(df)) == probabilities(fitted.transform(df)) != got  # training rows: other folds
    again = est.OrderEncoder.of(fc)
    again.write().overwrite().save(str(tmp_path / "stage"))
    assert est.OrderEncoder.load(str(tmp_path / "stage")).columns.to_dict() == fc.to_dict()


def test_training_rows_get_the_other_folds(spark, rows):
    df, fc = rows
    stage = est.OrderEncoder.of(fc).fit(df)
    one = stage.fitted.transform_oof(df, "fold").select("row_id", "features")
    two = stage.transform(df).select("row_id", F.col("features").alias("f2"))
    pairs = one.join(two, "row_id").collect()
    assert pairs and all(max(abs(r["features"].toArray() - r["f2"].toArray())) < 1e-12 for r in pairs)


def test_first_slots_are_dropped(spark, rows):
    df, fc = rows
    c0, c1 = fc.cat_cols[:2]
    few = FeatureColumns({c0: Role("one_hot", drop_first=True), c1: Role("one_hot"), **{n: fc.roles[n] for n in fc.num_cols[:1]}})
    e = mdl.fit_encoder(df, few)
    every = mdl.fit_encoder(df, FeatureColumns({**few.roles, c0: Role("one_hot")}))
    first = sorted(r[0] for r in df.select(F.col(f"`{c0}`").cast("string")).where(f"`{c0}` is not null").distinct().collect())[0]
    assert every.names[0] == f"{c0}_{first}" and e.names == every.names[1:]
    pairs = e.transform(df).select("row_id", "features").join(every.transform(df).select("row_id", F.col("features").alias("whole")), "row_id")
    assert all((r["features"].toArray() == r["whole"].toArray()[1:]).all() for r in pairs.collect())


def test_boosted_trees_fit_and_survive_saving(spark, rows, tmp_path):
    df, _ = rows
    df = c.tree_prep(df, c.TREE_CAT, c.TREE_NUM)
    safe = {n: f"c{i}" for i, n in enumerate(c.TREE_CAT + c.TREE_NUM)}
    data = df.select("row_id", "buyout_flag", *[F.col(f"`{n}`").alias(a) for n, a in safe.items()])
    cats, nums = [safe[n] for n in c.TREE_CAT], [safe[n] for n in c.TREE_NUM]
    model = mdl.BoostedTreeModel.fit(data, cats, nums, max_iter=6)
    first = {r["row_id"]: r["proba"] for r in model.predict_proba(data).collect()}
    y = {r["row_id"]: r["buyout_flag"] for r in data.collect()}
    mean = lambda k: sum(first[i] for i in y if y[i] == k) / max(1, sum(v == k for v in y.values()))
    assert first.keys() == y.keys() and all(0 < p < 1 for p in first.values()) and mean(1) > mean(0)
    mdl.save_boosted_model(model, str(tmp_path / "trees"))
    assert {r["row_id"]: r["proba"] for r in mdl.load_boosted_model(spark, str(tmp_path / "trees")).predict_proba(data).collect()} == first
    staged = Pipeline(stages=[est.BoostedTrees(catCols=cats, numCols=nums, maxIter=6)]).fit(data)
    staged.write().overwrite().save(str(tmp_path / "pipe"))
    assert probabilities(PipelineModel.load(str(tmp_path / "pipe")).transform(data)) == first
