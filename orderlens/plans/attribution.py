"""Tree attribution (M14): exact path-dependent SHAP values of a fitted
boosted-tree model, averaged as mean |value| per feature.

Plan: the model's node table (at most trees x 2^(depth+1) rows, read from
the saved model's ``data`` folder) is broadcast; rows are scored in Arrow
batches by ``mapInPandas``, where the tree recursion runs once per tree with
numpy vectors over the batch's rows (only the hot/cold direction depends
on the row); each batch emits per-feature partial sums, and a ``groupBy``
finishes the mean.  Every batch also checks additivity: the attributions
plus the expected value equal the model margin.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlens.session import staging_path


def node_table(model, spark) -> tuple[list[dict], list[float]]:
    """Per tree: arrays of children, split feature, threshold / left
    categories, leaf value and cover (weighted training count)."""
    path = staging_path(spark, "gbt-model")
    model.write().overwrite().save(path)
    data = spark.read.parquet(os.path.join(path, "data"))
    rows = data.select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
                       "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
                       "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories"
                       ).toPandas()  # bounded by the model size, not the data
    trees = []
    for tid, g in rows.groupby("treeID"):
        g = g.sort_values("id")
        n = int(g["id"].max()) + 1
        t = {k: np.zeros(n) for k in ("value", "cover", "thr")}
        t["left"] = np.full(n, -1, dtype=np.int64)
        t["right"] = np.full(n, -1, dtype=np.int64)
        t["feat"] = np.full(n, -1, dtype=np.int64)
        t["cats"] = [None] * n
        for r in g.itertuples(index=False):
            i = int(r.id)
            t["value"][i] = r.prediction
            t["cover"][i] = float(r.impurityStats[0])
            t["left"][i], t["right"][i] = int(r.leftChild), int(r.rightChild)
            if r.leftChild >= 0:
                t["feat"][i] = int(r.featureIndex)
                if int(r.numCategories) >= 0:
                    t["cats"][i] = np.asarray(r.leftCategoriesOrThreshold, dtype=float)
                else:
                    t["thr"][i] = float(r.leftCategoriesOrThreshold[0])
        trees.append((int(tid), t))
    trees.sort(key=lambda x: x[0])
    return [t for _, t in trees], list(model.treeWeights)


def _goes_left(t: dict, j: int, X: np.ndarray) -> np.ndarray:
    x = X[:, t["feat"][j]]
    if t["cats"][j] is not None:
        return np.isin(x, t["cats"][j]).astype(float)
    return (x <= t["thr"][j]).astype(float)


def _extend(path, pz, po, pi):
    depth = len(path)
    path.append([pi, pz, po, np.ones_like(po) if depth == 0 else np.zeros_like(po)])
    for i in range(depth - 1, -1, -1):
        path[i + 1][3] = path[i + 1][3] + po * path[i][3] * (i + 1) / (depth + 1)
        path[i][3] = pz * path[i][3] * (depth - i) / (depth + 1)


def _unwind(path, k):
    depth = len(path) - 1
    o, z = path[k][2], path[k][1]
    nxt = path[depth][3]
    on = o != 0
    safe_o = np.where(on, o, 1.0)
    for i in range(depth - 1, -1, -1):
        w = path[i][3]
        w_on = nxt * (depth + 1) / ((i + 1) * safe_o)
        nxt_on = w - w_on * z * (depth - i) / (depth + 1)
        w_off = (w * (depth + 1)) / (z * (depth - i)) if z != 0 else np.zeros_like(w)
        path[i][3] = np.where(on, w_on, w_off)
        nxt = np.where(on, nxt_on, nxt)
    for i in range(k, depth):
        path[i][0], path[i][1], path[i][2] = path[i + 1][0], path[i + 1][1], path[i + 1][2]
    path.pop()


def _unwound_sum(path, k):
    depth = len(path) - 1
    o, z = path[k][2], path[k][1]
    on = o != 0
    safe_o = np.where(on, o, 1.0)
    nxt = path[depth][3]
    tot_on = np.zeros_like(nxt)
    tot_off = np.zeros_like(nxt)
    for i in range(depth - 1, -1, -1):
        tmp = nxt / ((i + 1) * safe_o)
        tot_on = tot_on + tmp
        nxt = path[i][3] - tmp * z * (depth - i)
        if z != 0:
            tot_off = tot_off + path[i][3] / (z * (depth - i))
    return np.where(on, tot_on, tot_off) * (depth + 1)


def tree_shap(t: dict, X: np.ndarray, phi: np.ndarray, scale: float = 1.0) -> None:
    """Add ``scale`` x the SHAP values of one tree for all rows of X to phi."""
    n = X.shape[0]

    def rec(j, path, pz, po, pi):
        path = [e.copy() for e in path]
        _extend(path, pz, po, pi)
        if t["left"][j] < 0:
            v = t["value"][j] * scale
            for i in range(1, len(path)):
                w = _unwound_sum(path, i)
                phi[:, path[i][0]] += w * (path[i][2] - path[i][1]) * v
            return
        d = t["feat"][j]
        iz, io = 1.0, np.ones(n)
        for k in range(1, len(path)):
            if path[k][0] == d:
                iz, io = path[k][1], path[k][2]
                _unwind(path, k)
                break
        left, right = t["left"][j], t["right"][j]
        gl = _goes_left(t, j, X)
        c = t["cover"][j]
        rec(left, path, iz * t["cover"][left] / c, io * gl, d)
        rec(right, path, iz * t["cover"][right] / c, io * (1.0 - gl), d)

    rec(0, [], 1.0, np.ones(n), -1)


def expected_value(t: dict) -> float:
    leaves = t["left"] < 0
    return float((t["value"][leaves] * t["cover"][leaves]).sum() / t["cover"][0])


def predict_tree(t: dict, X: np.ndarray) -> np.ndarray:
    node = np.zeros(X.shape[0], dtype=np.int64)
    for _ in range(64):
        internal = t["left"][node] >= 0
        if not internal.any():
            break
        for j in np.unique(node[internal]):
            m = node == j
            gl = _goes_left(t, j, X[m]).astype(bool)
            node[m] = np.where(gl, t["left"][j], t["right"][j])
    return t["value"][node]


def shap_batch(trees, weights, X: np.ndarray):
    phi = np.zeros(X.shape)
    base = 0.0
    margin = np.zeros(X.shape[0])
    for t, w in zip(trees, weights):
        tree_shap(t, X, phi, w)
        base += w * expected_value(t)
        margin += w * predict_tree(t, X)
    return phi, base, margin


def mean_abs_attribution(df: DataFrame, model, feature_names: list[str], features_col: str = "features",
                         top_n: int = 20) -> DataFrame:
    """Mean |SHAP| per feature over the rows of ``df`` (top n), with the
    largest additivity error seen."""
    spark = df.sparkSession
    trees, weights = node_table(model, spark)
    bc = spark.sparkContext.broadcast((trees, weights))
    m = len(feature_names)

    def run(batches):
        ts, ws = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            X = np.stack(pdf["x"].to_numpy()).astype(float)
            phi, base, margin = shap_batch(ts, ws, X)
            err = float(np.max(np.abs(phi.sum(axis=1) + base - margin)))
            yield pd.DataFrame({"feature_idx": np.arange(m, dtype=np.int32),
                                "sum_abs": np.abs(phi).sum(axis=0),
                                "n": np.full(m, X.shape[0], dtype=np.int64),
                                "err": np.full(m, err)})

    parts = df.select(vector_to_array(F.col(features_col)).alias("x")).mapInPandas(
        run, "feature_idx int, sum_abs double, n long, err double")
    agg = parts.groupBy("feature_idx").agg((F.sum("sum_abs") / F.sum("n")).alias("mean_abs_shap"),
                                          F.max("err").alias("max_additivity_error"))
    names = spark.createDataFrame(list(enumerate(feature_names)), "feature_idx int, feature string")
    out = agg.join(F.broadcast(names), "feature_idx")  # one row per model feature
    top = out.orderBy(F.desc("mean_abs_shap"), F.asc("feature")).limit(top_n)
    w = Window.orderBy(F.desc("mean_abs_shap"), F.asc("feature"))  # <= top_n rows
    return top.select("feature", "mean_abs_shap", "max_additivity_error",
                      F.row_number().over(w).cast("int").alias("rank"))
