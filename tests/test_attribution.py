"""Tree attribution: vectorised TreeSHAP equals brute-force Shapley values
of the cover-weighted conditional expectation, and adds up to the margin."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler

from orderlens.plans import attribution as at


def cond_expect(t, x, S, j=0):
    if t["left"][j] < 0:
        return t["value"][j]
    d = t["feat"][j]
    l, r = t["left"][j], t["right"][j]
    if d in S:
        go_left = at._goes_left(t, j, x[None, :])[0] == 1.0
        return cond_expect(t, x, S, l if go_left else r)
    c = t["cover"][j]
    return (t["cover"][l] * cond_expect(t, x, S, l) + t["cover"][r] * cond_expect(t, x, S, r)) / c


def brute_shap(t, x, m):
    phi = np.zeros(m)
    for i in range(m):
        others = [k for k in range(m) if k != i]
        for size in range(m):
            for S in itertools.combinations(others, size):
                w = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                phi[i] += w * (cond_expect(t, x, set(S) | {i}) - cond_expect(t, x, set(S)))
    return phi


@pytest.fixture(scope="module")
def small_model(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(400):
        a, b, c, d = rnd.random(), rnd.random(), rnd.randint(0, 3), rnd.random()
        y = int(a + 0.5 * b + (c == 2) * 0.7 + 0.1 * rnd.random() > 1.0)
        rows.append((a, b, float(c), d, y))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, buyout_flag int")
    df = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    model = GBTClassifier(labelCol="buyout_flag", maxIter=4, maxDepth=3, seed=1).fit(df)
    return df, model


def test_tree_shap_matches_brute_force(spark, small_model):
    df, model = small_model
    trees, weights = at.node_table(model, spark)
    X = np.array([r["features"].toArray() for r in df.limit(25).collect()])
    for t in trees:
        phi = np.zeros(X.shape)
        at.tree_shap(t, X, phi)
        for r in range(X.shape[0]):
            assert np.allclose(phi[r], brute_shap(t, X[r], 4), atol=1e-10)


def test_attribution_job_adds_up(spark, small_model):
    df, model = small_model
    out = at.mean_abs_attribution(df, model, ["a", "b", "c", "d"]).collect()
    assert len(out) == 4 and max(r["max_additivity_error"] for r in out) < 1e-9
    trees, weights = at.node_table(model, spark)
    X = np.array([r["features"].toArray() for r in df.collect()])
    _, base, margin = at.shap_batch(trees, weights, X)
    raw = np.array([r["rawPrediction"][1] for r in model.transform(df).collect()])
    assert np.allclose(margin, raw, atol=1e-9)
