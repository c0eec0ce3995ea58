"""Boosted fit and full-feature fit at size: rows are dealt evenly, prepared once."""

import pytest
from pyspark.sql import functions as F

from orderlens import catalog as c
from orderlens.plans import models as mdl
from orderlens.plans.features import FeatureColumns, Role


class Seen(Exception):
    pass


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_even_parts_follow_rows_and_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [mdl.even_parts(spark, n) for n in (0, 1, 20_000, 20_001)] == [1, 1, 1, 2]
    assert mdl.even_parts(spark, cores * 20_000) == mdl.even_parts(spark, cores * 1_000_000) == cores
    assert mdl.even_parts(spark, cores * 1_000_000 + 1) == 2 * cores


def test_boosted_fit_deals_rows_of_one_partition(spark, monkeypatch):
    rows = (spark.range(50_000, numPartitions=1)
            .select(F.when(F.col("id") % 9 > 0, (F.col("id") % 7).cast("string")).alias("a b"),
                    (F.col("id") % 11).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("buyout_flag")))
    seen = []

    def fit(self, d):
        seen.append((d.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect(), self.getMaxBins()))
        raise Seen

    monkeypatch.setattr(mdl.GBTClassifier, "fit", fit)
    with pytest.raises(Seen):
        mdl.BoostedTreeModel.fit(rows, ["a b"], ["x"])
    sizes, bins = seen[0]
    assert len(sizes) == 3 and sum(sizes) == 50_000 and max(sizes) - min(sizes) <= 3 and bins == 166


def test_oof_encodings_join_stored_maps(spark):
    rows = [(i, f"v{i % 3}" if i % 10 else None, i % 4, int(i % 3 == 0)) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, v string, fold int, buyout_flag int")
    e = mdl.fit_encoder(df, FeatureColumns({"v": Role("encoded", group="geo", alpha=2.0)}))
    out = e.transform_oof(df, "fold")
    assert "Aggregate" not in plan(out) and "SortMergeJoin" not in plan(out)
    got = {r["row_id"]: r["features"][0] for r in out.collect()}
    for i, v, fold, _ in rows:
        ys = [y for _, w, f, y in rows if w == v and f != fold] if v else []
        want = (sum(ys) + e.global_mean * 2.0) / (len(ys) + 2.0) if ys else e.global_mean
        assert abs(got[i] - want) < 1e-12


def test_full_fit_ranks_its_folds_once(spark, monkeypatch):
    sf, seen = "/root/testdata/sf0.001", []
    key = (spark.sparkContext.applicationId, "full_fit", sf)
    monkeypatch.setattr(c, "_PREPARED", {k: v for k, v in c._PREPARED.items() if k != key})

    def fit(train, fc, fold_col=None):
        seen.append(train)
        raise Seen

    monkeypatch.setattr(mdl.FullFeatureModel, "fit", staticmethod(fit))
    with pytest.raises(Seen):
        c._full_fit(spark, sf)
    train = seen[0]
    assert set(train.columns) == {"row_id", "buyout_flag", "__fold", *c.FC.all_feature_cols}
    assert not any(step in plan(train) for step in ("Window", "Exchange", "Join"))
    by = {(r["buyout_flag"], r["__fold"]): r["count"] for r in train.groupBy("buyout_flag", "__fold").count().collect()}
    for y in (0, 1):
        sizes = [n for (label, _), n in by.items() if label == y]
        assert max(sizes) - min(sizes) <= 1
