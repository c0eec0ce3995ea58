"""All months of the expanding backtest in one fit (M12, X2, M2's rolling form).

Model k trains on the rows of all months before test month k.  Instead of one chain of jobs per
month, all models are fitted together: one pass over the rows computes the losses and gradients of
all months' models (rows times a coefficient matrix, masked by month), the partial sums of the
tasks are added in a tree, and the driver takes one step per model.  A pass also sums the models' X'WX, whose Newton steps need
some ten passes; above ``NEWTON_SIZE`` coefficients, where those matrices would not fit tasks,
limited-memory quasi-Newton steps reach the same optimum in more passes.  What reaches the driver
is models x coefficients (and their squares, some models at a time), never rows.

What an encoder fitted at month k would do is expressed in those terms: scaling moves into the
coefficients (means and deviations of every prefix of months come from one aggregate); a category
not seen before month k has no gradient there, so its weight stays zero as for an unknown one; and
target encodings are one array per row with the value as of each month, from one aggregate by
(value, fold, month) and prefix sums over the months.

The objective is that of ``models.logistic``: half the squared weights plus C times the weighted
log loss, balanced class weights; ``penalise_intercept`` counts the intercept among the weights,
as the rolling fit of the training notebook does.  Since the penalty's curvature is 1, the
distance to the optimum is at most the norm of the gradient that is left (with a penalised
intercept, for all coefficients), which ``tol`` bounds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.ops import Val, plain_text
from orderlens.operators import encode as enc
from orderlens.operators.lookups import heavy_values, left_lookup
from orderlens.plans.backtest import evaluated, month_col
from orderlens.plans.features import FeatureColumns
from orderlens.schema import DATE_COL, ROW_ID, TARGET
from orderlens.session import stage_table


#: Largest number of coefficients whose second derivatives are summed, and bytes of them a task holds.
NEWTON_SIZE = 2_048
HELD_BYTES = 64 << 20


@dataclass
class RollingDesign:
    """Staged model rows and the per-month statistics of the encoders.

    ``rows``: row id, y, m (month index), x (numbers and flags), c (category slots, -1 for none),
    t_j (encoding j of the row as of each month, own fold left out) and u (encodings at month m)."""
    rows: DataFrame
    months: list[str]
    tests: np.ndarray       # month indexes that get a model
    mean: np.ndarray        # months x numbers: of the rows before the month
    std: np.ndarray
    weight: np.ndarray      # months x 2: balanced class weights
    names: list[str]
    n_x: int
    n_t: int
    n_c: int
    fc: FeatureColumns

    @property
    def size(self) -> int:
        """Coefficients of one model: numbers, encodings, slots, intercept."""
        return self.n_x + self.n_t + self.n_c + 1

    @cached_property
    def tasks(self) -> int:
        return self.rows.rdd.getNumPartitions()


def _before(rows: list, names: list[str], cols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, positives, means and population variances of all rows before each month, by merging
    the months' own moments one after another."""
    n, p = np.zeros(len(rows)), np.zeros(len(rows))
    mean, var = np.zeros((len(rows), cols)), np.zeros((len(rows), cols))
    tn, tp, tm, ts = 0.0, 0.0, np.zeros(cols), np.zeros(cols)
    for k, r in enumerate(rows):
        n[k], p[k], mean[k] = tn, tp, tm
        var[k] = ts / tn if tn else 0.0
        own, m, v = float(r["n"]), np.array([r[f"a{j}"] for j in range(cols)], float), np.array([r[f"v{j}"] for j in range(cols)], float)
        delta, total = m - tm, tn + own
        ts = ts + v * own + delta**2 * tn * own / total
        tm = tm + delta * own / total
        tn, tp = total, tp + float(r["p"])
    return n, p, mean, var


def prepare(df: DataFrame, fc: FeatureColumns, target: str = TARGET, date_col: str = DATE_COL, period: str = "month",
            folds: int = 5, seed: int = 42, fold_col: str | None = None) -> RollingDesign:
    """The design of all months' models of ``fc`` on ``df`` (rows without a date are left out)."""
    spark = df.sparkSession
    numbers = [*fc.num_cols, *fc.bin_cols]
    fold = F.col(fold_col) if fold_col else enc.hash_folds(F.col(ROW_ID), folds, seed)
    x = [enc.passthrough(df, c) for c in numbers]
    cats = {f"__c{i}": plain_text(Val(F.col(f"`{c}`"), df.schema[c].dataType)) for i, c in enumerate(fc.cat_cols)}
    base = df.where(F.col(date_col).isNotNull()).select(
        ROW_ID, F.col(target).cast("int").alias("y"), month_col(date_col, period).alias("month"), fold.cast("int").alias("fold"),
        F.array(*x).cast("array<double>").alias("x"), *[c.alias(a) for a, c in cats.items()],
        *[F.col(f"`{c}`").alias(f"__v{j}") for j, c in enumerate(fc.te_cols)])
    base = stage_table(base, "rolling_base", spark)
    # one row a month
    stats = base.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"),
                                      *[F.avg(F.get("x", F.lit(j))).alias(f"a{j}") for j in range(len(numbers))],
                                      *[F.var_pop(F.get("x", F.lit(j))).alias(f"v{j}") for j in range(len(numbers))]).collect()
    stats.sort(key=lambda r: r["month"])
    months = [r["month"] for r in stats]
    n, p, mean, var = _before(stats, numbers, len(numbers))
    std = np.sqrt(var)
    std[std == 0] = 1.0
    mean[:, len(fc.num_cols):], std[:, len(fc.num_cols):] = 0.0, 1.0  # flags pass as they are
    own_n, own_p = np.array([r["n"] for r in stats], float), np.array([r["p"] for r in stats], float)
    ok = (p > 0) & (p < n) & (own_p > 0) & (own_p < own_n)
    tests = np.flatnonzero(ok & (np.arange(len(months)) > 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.stack([n / (2 * (n - p)), n / (2 * p)], axis=1)
    g = np.where(n > 0, p / np.maximum(n, 1), 0.5)

    names = list(numbers) + list(fc.te_cols)
    slots, n_c = [], 0
    rows = base.withColumn("m", (F.array_position(F.array(*[F.lit(m) for m in months]), F.col("month")) - 1).cast("int"))
    if fc.cat_cols:
        index = StringIndexer(inputCols=list(cats), outputCols=[f"__i{i}" for i in range(len(cats))],
                              stringOrderType="alphabetAsc", handleInvalid="keep").fit(base)
        rows = index.transform(rows)
        for i, (c, labels) in enumerate(zip(fc.cat_cols, index.labelsArray, strict=True)):
            drop = 1 if fc.cat_drop_first.get(c) and len(labels) else 0
            own = F.col(f"__i{i}").cast("int")
            slots.append(F.when((own >= len(labels)) | (own < drop), F.lit(-1)).otherwise(own - drop + n_c))
            names += [f"{c}_{v}" for v in labels[drop:]]
            n_c += len(labels) - drop
    rows = rows.select(ROW_ID, "y", "m", "fold", "x", F.array(*slots).cast("array<int>").alias("c"), *[f"__v{j}" for j in range(len(fc.te_cols))])
    last = []
    heavy = heavy_values(rows, [f"__v{j}" for j in range(len(fc.te_cols))]) if fc.te_cols else {}
    for j, c in enumerate(fc.te_cols):
        table = _encodings(rows, f"__v{j}", fc.te_alpha[c], g, folds)
        key = F.when(F.col(f"__v{j}").isNotNull(), F.struct(F.col(f"__v{j}").alias("value"), F.col("fold")))
        rows = left_lookup(rows, key, table.select(F.struct("value", "fold").alias("__key"), F.col("oof").alias(f"t_{j}"), F.col("all").alias(f"__a{j}")), "__key",
                           heavy[f"__v{j}"], (F.col(f"__v{j}"), F.col("__key.value")))
        unknown = F.array(*[F.lit(float(v)) for v in g])
        rows = rows.withColumns({f"t_{j}": F.coalesce(f"t_{j}", unknown), f"__a{j}": F.coalesce(f"__a{j}", unknown)})
        last.append(F.get(F.col(f"__a{j}"), F.col("m")))
    rows = rows.select(ROW_ID, "y", "m", "x", "c", *[f"t_{j}" for j in range(len(fc.te_cols))], F.array(*last).cast("array<double>").alias("u"))
    # each row costs one product per month: even shares matter more than file sizes
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), ROW_ID)
    return RollingDesign(stage_table(rows, "rolling_rows", spark), months, tests, mean, std, weight, names, len(numbers), len(fc.te_cols), n_c, fc)


def _encodings(rows: DataFrame, col: str, alpha: float, g: np.ndarray, folds: int) -> DataFrame:
    """(value, fold, oof, all): the smoothed mean target of a value over the rows before each month,
    without the fold's own rows and over all folds."""
    entry = F.struct("fold", "m", "s", "n")
    by = (rows.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"), "fold", "m")
              .agg(F.sum("y").cast("double").alias("s"), F.count(F.lit(1)).cast("double").alias("n"))
              .groupBy("value").agg(F.collect_list(entry).alias("e")))  # at most folds x months entries a value
    n_months = len(g)

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        smooth = lambda s, n: np.where(n > 0, (s + g * alpha) / np.where(n + alpha > 0, n + alpha, 1.0), g)
        for pdf in batches:
            out = []
            for value, entries in zip(pdf["value"], pdf["e"], strict=True):
                s, n = np.zeros((folds, n_months + 1)), np.zeros((folds, n_months + 1))
                for e in entries:
                    s[e["fold"], e["m"] + 1] += e["s"]
                    n[e["fold"], e["m"] + 1] += e["n"]
                s, n = s.cumsum(axis=1)[:, :n_months], n.cumsum(axis=1)[:, :n_months]
                every = smooth(s.sum(axis=0), n.sum(axis=0))
                for f in range(folds):
                    out.append((value, f, smooth(s.sum(axis=0) - s[f], n.sum(axis=0) - n[f]), every))
            yield pd.DataFrame(out, columns=["value", "fold", "oof", "all"])

    kind = rows.schema[col].dataType.simpleString()
    return by.mapInPandas(arrays, f"value {kind}, fold int, oof array<double>, `all` array<double>")


def _matrix(col: pa.Array, width: int, kind) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(col), width)


@dataclass(frozen=True)
class _Models:
    """Coefficients of some models in the units of the rows: slopes and offsets of raw numbers."""
    tests: np.ndarray
    slope: np.ndarray    # models x numbers
    offset: np.ndarray   # models
    enc: np.ndarray      # models x encodings
    slot: np.ndarray     # models x slots
    weight: np.ndarray   # models x 2

    def __len__(self) -> int:
        return len(self.tests)


def _models(d: RollingDesign, w: np.ndarray, which: np.ndarray) -> _Models:
    k = d.tests[which]
    slope = w[:, :d.n_x] / d.std[k]
    offset = w[:, -1] - (slope * d.mean[k]).sum(axis=1)
    return _Models(k, slope, offset, w[:, d.n_x:d.n_x + d.n_t], w[:, d.n_x + d.n_t:-1], d.weight[k])


def _by_slot(slots: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    """out[slot] += the sum of the rows of ``values`` with that slot."""
    use = np.flatnonzero(slots >= 0)
    if len(use):
        order = use[np.argsort(slots[use], kind="stable")]
        found, starts = np.unique(slots[order], return_index=True)
        out[found] += np.add.reduceat(values[order], starts, axis=0)


def _decoded(batch: pa.RecordBatch, shape: tuple, tests: np.ndarray):
    """y, months, numbers, category slots and encodings (per encoding rows x models) of a batch."""
    d_x, d_t, _, n_cats, n_months = shape
    col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    t = [_matrix(col[f"t_{j}"], n_months, float)[:, tests] for j in range(d_t)]
    return (col["y"].to_numpy().astype(float), col["m"].to_numpy(), _matrix(col["x"], d_x, float), _matrix(col["c"], n_cats, np.int64), t)


#: Rows whose design is held at once while second derivatives are summed (it stays in a core's cache).
BLOCK = 512


def _second(x: np.ndarray, c: np.ndarray, t: list, h: np.ndarray, until: np.ndarray, d_c: int) -> np.ndarray:
    """models x upper triangle of X'WX (by rows).  Rows are in the order of months, and model k
    trains on the first ``until[k]``.  A block's design is made once for all models, which differ
    in its encodings' columns and weights only; X'WX = (sqrt(W)X)'(sqrt(W)X) is symmetric, so half
    of it is computed and sent."""
    d_x, n_t = x.shape[1], len(t)
    size = d_x + n_t + d_c + 1
    out = np.zeros((len(until), size, size))
    root, by_model = np.sqrt(h.T), [np.ascontiguousarray(v.T) for v in t]
    part = np.empty((BLOCK, size))
    for a in range(0, len(x), BLOCK):
        n = min(BLOCK, len(x) - a)
        full = np.zeros((n, size))
        full[:, :d_x], full[:, -1] = x[a:a + n], 1.0
        for i in range(c.shape[1]):
            use = np.flatnonzero(c[a:a + n, i] >= 0)
            full[use, d_x + n_t + c[a + use, i]] = 1.0
        for k in np.flatnonzero(until > a):
            own = min(n, until[k] - a)
            for j in range(n_t):
                full[:own, d_x + j] = by_model[j][k, a:a + own]
            held = np.multiply(full[:own], root[k, a:a + own, None], out=part[:own])
            out[k] += held.T @ held
    return out[(slice(None), *np.triu_indices(size))]


def _batch_sums(batch: pa.RecordBatch, shape: tuple, mod: _Models, second: str) -> np.ndarray:
    """models x (loss, gradient[, second derivatives]) in the rows' units: numbers, encodings,
    slots, offset.  ``second``: "none", "diagonal" or "full"."""
    d_x, d_t, d_c, n_cats, _ = shape
    y, m, x, c, t = _decoded(batch, shape, mod.tests)
    if second == "full":
        order = np.argsort(m, kind="stable")
        y, m, x, c, t = y[order], m[order], x[order], c[order], [v[order] for v in t]
    z = x @ mod.slope.T + mod.offset
    for j in range(d_t):
        z += t[j] * mod.enc[:, j]
    table = np.vstack([mod.slot.T, np.zeros((1, len(mod)))])  # the last row serves slot -1
    for i in range(n_cats):
        z += table[c[:, i]]
    trains = m[:, None] < mod.tests[None, :]
    weight = np.where(trains, np.where(y[:, None] == 1, mod.weight[:, 1], mod.weight[:, 0]), 0.0)
    loss = (weight * (np.logaddexp(0.0, z) - y[:, None] * z)).sum(axis=0)
    prob = 0.5 * (1.0 + np.tanh(0.5 * z))
    r, h = weight * (prob - y[:, None]), weight * prob * (1 - prob)

    def sums(r: np.ndarray, square: bool) -> np.ndarray:
        slot = np.zeros((d_c, len(mod)))
        for i in range(n_cats):
            _by_slot(c[:, i], r, slot)
        encs = [(r * (t[j] ** 2 if square else t[j])).sum(axis=0)[:, None] for j in range(d_t)]
        return np.hstack([r.T @ (x * x if square else x), *encs, slot.T, r.sum(axis=0)[:, None]])

    parts = [loss[:, None], sums(r, False)]
    if second == "diagonal":
        parts += [sums(h, True), h.T @ x]
    elif second == "full":
        parts.append(_second(x, c, t, h, trains.sum(axis=0), d_c))
    return np.hstack(parts)


def _sum_over_rows(d: RollingDesign, mod: _Models, second: str) -> np.ndarray:
    """The tasks' sums, added in two levels; one array reaches the driver, whatever the number of tasks."""
    sent = d.rows.sparkSession.sparkContext.broadcast(mod)  # models x coefficients
    shape = (d.n_x, d.n_t, d.n_c, len(d.fc.cat_cols), len(d.months))
    size = (len(mod), 1 + d.size + {"none": 0, "diagonal": d.size + d.n_x, "full": d.size * (d.size + 1) // 2}[second])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += _batch_sums(batch, shape, sent.value, second)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column(0):
                total += np.frombuffer(part.as_buffer()).reshape(size)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    groups = math.isqrt(max(d.tasks, 1) - 1) + 1
    parts = d.rows.drop(ROW_ID, "u").mapInArrow(partial, "sums binary").repartition(groups).mapInArrow(added, "sums binary")
    total = np.frombuffer(parts.repartition(1).mapInArrow(added, "sums binary").first()[0]).reshape(size)
    sent.unpersist()
    return total


def objective(d: RollingDesign, c: float, penalise_intercept: bool) -> Callable:
    """(losses, gradients[, second derivatives]) of the models ``which`` at coefficients ``w``."""
    shrink = np.ones(d.size)
    shrink[-1] = float(penalise_intercept)

    def evaluate(w: np.ndarray, which: np.ndarray, second: str = "none"):
        mod = _models(d, w, which)
        raw = _sum_over_rows(d, mod, second)
        mean, std, k = d.mean[mod.tests], d.std[mod.tests], d.n_x
        loss, first, more = raw[:, 0], raw[:, 1:1 + d.size], raw[:, 1 + d.size:]
        # what the rows' units make of the coefficients: slope = w / std, offset = intercept - slope * mean
        grad = first.copy()
        grad[:, :k] = (first[:, :k] - first[:, -1:] * mean) / std
        value, grad = c * loss + 0.5 * (w * w * shrink).sum(axis=1), c * grad + w * shrink
        if second == "none":
            return value, grad
        if second == "diagonal":
            diag, hx = more[:, :d.size].copy(), more[:, d.size:]
            diag[:, :k] = (diag[:, :k] - 2 * mean * hx + mean**2 * more[:, d.size - 1:d.size]) / std**2
            return value, grad, np.maximum(c * diag + shrink, 1e-12)
        hess = np.zeros((len(which), d.size, d.size))
        up = np.triu_indices(d.size)
        hess[:, up[0], up[1]] = hess[:, up[1], up[0]] = more
        turn = np.tile(np.eye(d.size), (len(which), 1, 1))
        turn[:, np.arange(k), np.arange(k)] = 1.0 / std
        turn[:, -1, :k] = -mean / std
        return value, grad, c * np.swapaxes(turn, 1, 2) @ hess @ turn + np.diag(shrink)

    return evaluate


_dot = lambda a, b: (a * b).sum(axis=1)


def _moved(evaluate: Callable, w: np.ndarray, f: np.ndarray, step: np.ndarray, slope: np.ndarray, live: np.ndarray, second: str):
    """Each model's first point along its step that lowers its objective enough, with what is known
    there; passes serve the models that still look for one."""
    length, todo, passes = np.ones(len(live)), np.arange(len(live)), 0
    found: list = [None] * len(live)
    for _ in range(40):
        at = w[todo] + length[todo, None] * step[todo]
        got = evaluate(at, live[todo], second)
        passes += 1
        good = got[0] <= f[todo] + 1e-4 * length[todo] * slope[todo] + 1e-13 * np.abs(f[todo])
        for i in np.flatnonzero(good):
            found[todo[i]] = (at[i], *[x[i] for x in got])
        todo = todo[~good]
        if not len(todo):
            break
        length[todo] *= 0.3
    return found, passes


def newton(evaluate: Callable, models: int, size: int, tol: float = 1e-8, max_iter: int = 60) -> tuple[np.ndarray, np.ndarray, int]:
    """Newton steps of all models side by side.  Returns coefficients, gradient norms, passes."""
    per = max(1, HELD_BYTES // (8 * (size + 1) ** 2))
    w_all, left, most = np.zeros((models, size)), np.zeros(models), 0
    for start in range(0, models, per):
        every = np.arange(start, min(start + per, models))
        w = np.zeros((len(every), size))
        f, g, h = evaluate(w, every, "full")
        passes = 1
        for _ in range(max_iter):
            live = np.flatnonzero(np.sqrt(_dot(g, g)) > tol)
            if not len(live):
                break
            step = -np.linalg.solve(h[live], g[live][:, :, None])[:, :, 0]
            found, more = _moved(evaluate, w[live], f[live], step, _dot(g[live], step), every[live], "full")
            passes += more
            still = False
            for i, at in zip(live, found, strict=True):
                if at is not None and (at[0] != w[i]).any():
                    w[i], f[i], g[i], h[i] = at
                    still = True
            if not still:
                break
        w_all[every], left[every] = w, np.sqrt(_dot(g, g))
        most += passes
    return w_all, left, most


def quasi_newton(evaluate: Callable, models: int, size: int, tol: float = 1e-6, max_iter: int = 1000, memory: int = 12) -> tuple[np.ndarray, np.ndarray, int]:
    """Limited-memory quasi-Newton steps of all models side by side, scaled by the second
    derivatives' diagonal at zero.  Returns coefficients, gradient norms, passes."""
    every = np.arange(models)
    w = np.zeros((models, size))
    f, g, diag = evaluate(w, every, "diagonal")
    passes = 1
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iter):
        live = np.flatnonzero(np.sqrt(_dot(g, g)) > tol)
        if not len(live):
            break
        q, alphas = g[live].copy(), []
        usable = [(s[live], v[live]) for s, v in pairs]
        curved = [np.where(_dot(s, v) > 0, 1.0 / np.where(_dot(s, v) > 0, _dot(s, v), 1.0), 0.0) for s, v in usable]
        for (s, v), rho in zip(reversed(usable), reversed(curved), strict=True):
            a = rho * _dot(s, q)
            alphas.append(a)
            q -= a[:, None] * v
        q /= diag[live]
        if usable:
            s, v = usable[-1]
            scale = _dot(v, v / diag[live])
            q *= np.where((scale > 0) & (curved[-1] > 0), _dot(s, v) / np.where(scale > 0, scale, 1.0), 1.0)[:, None]
        for (s, v), rho, a in zip(usable, curved, reversed(alphas), strict=True):
            q += (a - rho * _dot(v, q))[:, None] * s
        step = -q
        uphill = _dot(g[live], step) >= 0
        step[uphill] = -(g[live] / diag[live])[uphill]
        found, more = _moved(evaluate, w[live], f[live], step, _dot(g[live], step), live, "none")
        passes += more
        s, v = np.zeros_like(w), np.zeros_like(w)
        for i, at in zip(live, found, strict=True):
            if at is not None:
                s[i], v[i] = at[0] - w[i], at[2] - g[i]
                w[i], f[i], g[i] = at
        if not s.any():
            break
        pairs = [*pairs, (s, v)][-memory:]
    return w, np.sqrt(_dot(g, g)), passes


@dataclass
class RollingModels:
    """Coefficients by test month: numbers (per scaled unit), encodings, slots, intercept."""
    design: RollingDesign
    w: np.ndarray
    left: np.ndarray     # gradient norms at the end
    passes: int

    def coefficients(self) -> DataFrame:
        """(test_month, name, weight), the intercept as ``(intercept)``: models x coefficients rows."""
        names = [*self.design.names, "(intercept)"]
        rows = [(self.design.months[k], n, float(v)) for k, row in zip(self.design.tests, self.w, strict=True) for n, v in zip(names, row, strict=True)]
        return self.design.rows.sparkSession.createDataFrame(rows, "test_month string, name string, weight double")

    def scores(self) -> DataFrame:
        """(row_id, test_month, y, p) of the rows of all test months, each by its month's model."""
        d = self.design
        mod = _models(d, self.w, np.arange(len(d.tests)))
        place = np.full(len(d.months), -1)
        place[d.tests] = np.arange(len(d.tests))
        spark = d.rows.sparkSession
        sent = spark.sparkContext.broadcast(mod)
        n_x, n_t, n_cats, months = d.n_x, d.n_t, len(d.fc.cat_cols), d.months

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mod = sent.value
            table = np.hstack([mod.slot, np.zeros((len(mod), 1))])
            for batch in batches:
                col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                k = place[col["m"].to_numpy()]
                use = np.flatnonzero(k >= 0)
                k = k[use]
                z = mod.offset[k] + (_matrix(col["x"], n_x, float)[use] * mod.slope[k]).sum(axis=1)
                z += (_matrix(col["u"], n_t, float)[use] * mod.enc[k]).sum(axis=1)
                slots = _matrix(col["c"], n_cats, np.int64)[use]
                for i in range(n_cats):
                    z += table[k, slots[:, i]]
                pick = pa.array(use)
                yield pa.RecordBatch.from_arrays(
                    [col[ROW_ID].take(pick), pa.array([months[j] for j in mod.tests[k]], pa.string()), col["y"].take(pick), pa.array(0.5 * (1 + np.tanh(0.5 * z)))],
                    names=[ROW_ID, "test_month", "y", "p"])

        kind = d.rows.schema[ROW_ID].dataType.simpleString()
        rows = d.rows.select(ROW_ID, "y", "m", "x", "c", "u")
        return rows.mapInArrow(run, f"{ROW_ID} {kind}, test_month string, y int, p double")


def fit(d: RollingDesign, c: float = 1.0, penalise_intercept: bool = True, tol: float = 1e-6) -> RollingModels:
    solve = newton if d.size <= NEWTON_SIZE else quasi_newton
    return RollingModels(d, *solve(objective(d, c, penalise_intercept), len(d.tests), d.size, tol))


def rolling_backtest(df: DataFrame, fc: FeatureColumns, target: str = TARGET, date_col: str = DATE_COL, period: str = "month",
                     penalise_intercept: bool = True) -> DataFrame:
    """M12 for the full-feature logistic model: one row per eligible month, as ``cumulative_months_loop``."""
    models = fit(prepare(df, fc, target, date_col, period), penalise_intercept=penalise_intercept)
    return evaluated(models.scores(), df, target, date_col, period)
