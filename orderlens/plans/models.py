"""Models: encoder (X3/E6), logistic models (M1, M2), boosted trees (M3),
routed scoring (M4, M5), persistence (S6), calibration points (M15).

Fits are MLlib jobs (each optimizer step is a distributed tree-aggregate);
nothing is collected to the driver except model coefficients and small
fitted vocabularies.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.ops import Val, plain_text
from orderlens.operators import encode as enc
from orderlens.operators.clean import is_new_column
from orderlens.plans.features import FeatureColumns, build_features
from orderlens.schema import DEAL_COUNT_COL, ROW_ID, TARGET
from orderlens.session import stage_table


def class_counts(df: DataFrame, target: str = TARGET) -> tuple[int, int]:
    """(rows, positives) in one aggregate."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("p")).first()
    return int(r["n"]), int(r["p"] or 0)


def balanced_weights(n: int, p: int) -> tuple[float, float, float]:
    """'balanced' class weights n / (2 * n_class): (w0, w1, sum of weights)."""
    w1 = n / (2.0 * p) if p else 0.0
    w0 = n / (2.0 * (n - p)) if n - p else 0.0
    return w0, w1, w1 * p + w0 * (n - p)


def class_weights(df: DataFrame, target: str = TARGET, counts: tuple[int, int] | None = None) -> Column:
    """'balanced' weights as a column."""
    n, p = counts or class_counts(df, target)
    w0, w1, _ = balanced_weights(n, p)
    return F.when(F.col(target) == 1, F.lit(w1)).otherwise(F.lit(w0))


def even_parts(spark, n: int, least: int = 20_000, most: int = 1_000_000) -> int:
    """Partitions for n rows that are read many times: one for each core, but of ``least`` to
    ``most`` rows each (above that a multiple of the cores)."""
    cores = max(1, spark.sparkContext.defaultParallelism)
    return max(1, min(cores, -(-n // least))) if n <= cores * most else cores * -(-n // (cores * most))


def _text(df: DataFrame, c: str) -> Column:
    return plain_text(Val(F.col(f"`{c}`"), df.schema[c].dataType))


@dataclass
class OrderEncoderModel:
    """Fitted encoder: one-hot (alphabetical slots, NULL/unseen -> zeros),
    scaled numerics, pass-through binaries, smoothed target encodings."""
    fc: FeatureColumns
    index_model: PipelineModel | None
    scale: dict
    te_maps: dict
    global_mean: float
    names: list[str] = field(default_factory=list)
    group_map: dict = field(default_factory=dict)
    kept: list[int] | None = None  # columns that stay where a feature's first slot is dropped

    def _base(self, df: DataFrame) -> DataFrame:
        fc = self.fc
        upd = {f"__cat_{i}": _text(df, c) for i, c in enumerate(fc.cat_cols)}
        for i, c in enumerate(fc.num_cols):
            upd[f"__num_{i}"] = enc.scaled(df, c, self.scale[c])
        for i, c in enumerate(fc.bin_cols):
            upd[f"__bin_{i}"] = enc.passthrough(df, c)
        out = df.withColumns(upd) if upd else df
        if self.index_model is not None:
            out = self.index_model.transform(out)
        return out

    def _assemble(self, df: DataFrame, te_out: list[str]) -> DataFrame:
        fc = self.fc
        inputs = ([f"__oh_{i}" for i in range(len(fc.cat_cols))]
                  + [f"__num_{i}" for i in range(len(fc.num_cols))]
                  + [f"__bin_{i}" for i in range(len(fc.bin_cols))] + te_out)
        if self.kept is None:
            return VectorAssembler(inputCols=inputs, outputCol="features").transform(df)
        whole = VectorAssembler(inputCols=inputs, outputCol="__every").transform(df)
        return VectorSlicer(inputCol="__every", outputCol="features", indices=self.kept).transform(whole).drop("__every")

    def transform(self, df: DataFrame) -> DataFrame:
        out = self._base(df)
        te_out = []
        for i, c in enumerate(self.fc.te_cols):
            out = enc.apply_target_map(out, c, self.te_maps[c], self.global_mean, f"__te_{i}")
            te_out.append(f"__te_{i}")
        return self._assemble(out, te_out)

    def transform_oof(self, df: DataFrame, fold_col: str, target: str = TARGET) -> DataFrame:
        """Training-time transform: target encodings out of fold (E5)."""
        out = self._base(df)
        te_out = []
        for i, c in enumerate(self.fc.te_cols):
            # a stored map has a known size, so that the rows need not be dealt to meet it
            table = stage_table(enc.oof_map(df, c, target, fold_col, self.fc.te_alpha[c], self.global_mean), "oof_map")
            out = enc.apply_oof(out, c, fold_col, table, self.global_mean, f"__te_{i}")
            te_out.append(f"__te_{i}")
        return self._assemble(out, te_out)


def fit_encoder(df: DataFrame, fc: FeatureColumns, target: str = TARGET,
                counts: tuple[int, int] | None = None) -> OrderEncoderModel:
    n, p = counts or class_counts(df, target)
    g = p / n if n else 0.5
    stages = []
    labels = {}
    if fc.cat_cols:
        cats = [f"__cat_{i}" for i in range(len(fc.cat_cols))]
        stages.append(StringIndexer(inputCols=cats, outputCols=[f"__idx_{i}" for i in range(len(cats))],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"__idx_{i}" for i in range(len(cats))],
                                    outputCols=[f"__oh_{i}" for i in range(len(cats))],
                                    dropLast=True))  # the dropped last slot is the unknown one
    tmp = df.withColumns({f"__cat_{i}": _text(df, c) for i, c in enumerate(fc.cat_cols)}) if fc.cat_cols else df
    index_model = Pipeline(stages=stages).fit(tmp) if stages else None
    names, group, kept, width = [], {}, [], 0
    if index_model is not None:
        for c, labs in zip(fc.cat_cols, index_model.stages[0].labelsArray):
            drop = int(bool(fc.cat_drop_first.get(c)))  # E1: the first value is the reference
            for lab in labs[drop:]:
                names.append(f"{c}_{lab}")
                group[f"{c}_{lab}"] = c
            kept += range(width + drop, width + len(labs))
            width += len(labs)
    scale = {c: enc.scale_stats(df, c) for c in fc.num_cols}
    te_maps = {c: stage_table(enc.target_map(df, c, target, fc.te_alpha[c], g), "target_map") for c in fc.te_cols}
    rest = fc.num_cols + fc.bin_cols + fc.te_cols
    for c in rest:
        names.append(c)
        group[c] = c
    kept += range(width, width + len(rest))
    return OrderEncoderModel(fc, index_model, scale, te_maps, g, names, group, None if len(kept) == width + len(rest) else kept)


def logistic(weight_col: str | None, n_weight: float, c: float = 1.0, max_iter: int = 1000,
             tol: float = 1e-4):
    """L2 logistic regression with the sklearn objective (C, summed loss):
    regParam = 1 / (C * sum of weights), free intercept, no standardization,
    the solver's default tolerance 1e-4."""
    kw = dict(featuresCol="features", labelCol=TARGET, maxIter=max_iter, elasticNetParam=0.0,
              regParam=1.0 / (c * max(n_weight, 1.0)), standardization=False, fitIntercept=True,
              tol=tol)
    if weight_col:
        kw["weightCol"] = weight_col
    return LogisticRegression(**kw)


def positive_proba(df: DataFrame) -> Column:
    return vector_to_array(F.col("probability"))[1]


@dataclass(frozen=True)
class Line:
    """A logistic curve of one scaled number."""
    intercept: float
    coefficients: tuple[float]

    @staticmethod
    def fit(train: DataFrame, z: Column, target: str, weights: tuple[float, float], c: float = 1.0, tol: float = 1e-10) -> "Line":
        """Newton steps of half the squared coefficient plus c times the weighted log loss (free
        intercept).  Rows are counted by (z, target) once; each step is one aggregate of X'WX sums
        over those counts, and two numbers reach the driver."""
        counts = stage_table(train.groupBy(z.alias("z"), F.col(target).cast("double").alias("y"))
                                  .agg(F.count(F.lit(1)).cast("double").alias("n")), "line_counts")
        w = F.when(F.col("y") == 1, F.lit(weights[1])).otherwise(F.lit(weights[0])) * F.col("n") * F.lit(c)

        def sums(b: float, a: float):
            t = F.lit(b) + F.lit(a) * F.col("z")
            q = F.lit(1.0) / (F.lit(1.0) + F.exp(-t))
            loss = F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t))) - F.col("y") * t
            h, r, zz = w * q * (1 - q), w * (q - F.col("y")), F.col("z")
            got = counts.agg(*[F.sum(x) for x in (w * loss, r, r * zz, h, h * zz, h * zz * zz)]).first()
            f, gb, ga, hbb, hba, haa = (x or 0.0 for x in got)
            return f + 0.5 * a * a, gb, ga + a, hbb, hba, haa + 1.0

        b = a = 0.0
        f, gb, ga, hbb, hba, haa = sums(b, a)
        for _ in range(60):
            det = hbb * haa - hba * hba
            if max(abs(gb), abs(ga)) <= tol or det <= 0:
                break
            db, da = (haa * gb - hba * ga) / det, (hbb * ga - hba * gb) / det
            length, moved = 1.0, None
            while length > 1e-8:
                moved = sums(b - length * db, a - length * da)
                if moved[0] <= f + 1e-13 * abs(f):
                    break
                length /= 2
            if (b - length * db, a - length * da) == (b, a):
                break
            b, a = b - length * db, a - length * da
            f, gb, ga, hbb, hba, haa = moved
        return Line(b, (a,))

    def proba(self, z: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.intercept) + F.lit(self.coefficients[0]) * z)))


@dataclass
class PriorCountModel:
    """M1: scaled prior-order count -> balanced logistic regression."""
    scale: enc.ScaleStats
    lr: Line

    @staticmethod
    def fit(train: DataFrame) -> "PriorCountModel":
        st = enc.scale_stats(train, DEAL_COUNT_COL)
        n, p = class_counts(train)
        return PriorCountModel(st, Line.fit(train, enc.scaled(train, DEAL_COUNT_COL, st), TARGET, balanced_weights(n, p)[:2]))

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return df.select(ROW_ID, self.lr.proba(enc.scaled(df, DEAL_COUNT_COL, self.scale)).alias("proba"))


@dataclass
class FullFeatureModel:
    """M2: encoder (OOF target encoding at fit) -> balanced logistic regression."""
    encoder: OrderEncoderModel
    lr: object

    @staticmethod
    def fit(train: DataFrame, fc: FeatureColumns, fold_col: str | None = None,
            k: int = 5, seed: int = 42) -> "FullFeatureModel":
        n, p = class_counts(train)
        e = fit_encoder(train, fc, counts=(n, p))
        if fold_col is None:
            train = train.withColumn("__fold", enc.hash_folds(F.col(ROW_ID), enc.n_folds(p, n - p, k), seed))
            fold_col = "__fold"
        d = e.transform_oof(train, fold_col).withColumn("__w", class_weights(train, counts=(n, p)))
        return FullFeatureModel(e, logistic("__w", balanced_weights(n, p)[2]).fit(d))

    def predict_proba(self, df: DataFrame) -> DataFrame:
        out = self.lr.transform(self.encoder.transform(df))
        return out.select(ROW_ID, positive_proba(out).alias("proba"))

    def coefficients(self, spark) -> DataFrame:
        w = self.lr.coefficients.toArray().tolist()
        rows = [(n, float(v), self.encoder.group_map.get(n, n)) for n, v in zip(self.encoder.names, w)]
        return spark.createDataFrame(rows, "name string, weight double, feature string")


@dataclass
class BoostedTreeModel:
    """M3: gradient-boosted trees on indexed categoricals + numbers."""
    pipeline: PipelineModel
    cat_cols: list[str]
    num_cols: list[str]

    @staticmethod
    def fit(train: DataFrame, cat_cols: list[str], num_cols: list[str], max_iter: int = 500,
            depth: int = 4, step: float = 0.03, min_leaf: int = 5, bins: int = 166,
            seed: int = 42) -> "BoostedTreeModel":
        from orderlens.session import shared_dir
        shared_dir(train.sparkSession)  # boosting checkpoints (every 10 rounds) go to the shared folder
        idx = [f"__gi_{i}" for i in range(len(cat_cols))]
        counts = class_counts(train)
        # every round reads all rows once a level, in as many tasks as there are partitions
        d = (train.select(*[F.col(f"`{c}`") for c in [*cat_cols, *num_cols, TARGET]])
                  .withColumn("__w", class_weights(train, counts=counts))
                  .repartition(even_parts(train.sparkSession, counts[0])).persist())
        stages, max_bins = [], bins
        try:
            if cat_cols:
                stages.append(StringIndexer(inputCols=cat_cols, outputCols=idx,
                                            stringOrderType="alphabetAsc", handleInvalid="keep").fit(d))
                max_bins = max([bins] + [int(len(labels) * 1.1) + 8 for labels in stages[0].labelsArray])
            stages.append(VectorAssembler(inputCols=idx + num_cols, outputCol="features"))
            trees = GBTClassifier(featuresCol="features", labelCol=TARGET, weightCol="__w",
                                  maxIter=max_iter, maxDepth=depth, stepSize=step,
                                  minInstancesPerNode=min_leaf, maxBins=max_bins, seed=seed,
                                  # shallow trees: node-id caching costs more than it saves
                                  cacheNodeIds=False, checkpointInterval=10).fit(PipelineModel(stages).transform(d))
        finally:
            d.unpersist()
        return BoostedTreeModel(PipelineModel([*stages, trees]), cat_cols, num_cols)

    def predict_proba(self, df: DataFrame) -> DataFrame:
        out = self.pipeline.transform(df)
        return out.select(ROW_ID, positive_proba(out).alias("proba"))


@dataclass
class FixedLogistic:
    """A logistic scorer with given coefficients (``prep`` adds inputs)."""
    coef: dict
    intercept: float
    prep: Callable[[DataFrame], DataFrame] | None = None

    def predict_proba(self, df: DataFrame) -> DataFrame:
        d = self.prep(df) if self.prep else df
        z = F.lit(self.intercept)
        for c, w in self.coef.items():
            z = z + F.lit(w) * F.col(f"`{c}`")
        return d.select(ROW_ID, (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("proba"))


def route_and_score(df: DataFrame, config: dict, contexts: dict, new_model, returning_model,
                    threshold: float = 0.5) -> DataFrame:
    """M4 + M5: send new contacts (prior count < 1 or NULL) through the
    feature build to ``new_model`` and the rest to ``returning_model``; one
    probability per input row (keyed by row id), decision = proba >= threshold."""
    # route first: only the new-contact model reads the built features (they
    # are row-wise given fixed contexts, so building them on that route alone
    # gives the same values and skips the lookups for returning contacts)
    flag = is_new_column()
    feats_new, _ = build_features(df.filter(flag), config, contexts)
    new = new_model.predict_proba(feats_new).withColumn("route", F.lit("new"))
    ret = returning_model.predict_proba(df.filter(~flag)).withColumn("route", F.lit("returning"))
    out = new.unionByName(ret)
    return out.select(ROW_ID, "route", "proba",
                      (F.col("proba") >= F.lit(threshold)).cast("int").alias("decision"))


# ---------------------------------------------------------------------------
# persistence
# ---------------------------------------------------------------------------

def save_contexts(contexts: dict, path: str) -> None:
    """One parquet folder per context table + a small manifest."""
    manifest = {}
    for name, t in contexts.items():
        t.df.write.mode("overwrite").parquet(os.path.join(path, name))
        manifest[name] = {k: v for k, v in t.__dict__.items() if k != "df"} | {"kind": type(t).__name__}
    spark = next(iter(contexts.values())).df.sparkSession
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string") \
         .write.mode("overwrite").json(os.path.join(path, "_manifest"))


def load_contexts(spark, path: str) -> dict:
    from orderlens.functions.ops import MapTable, RowsTable
    manifest = json.loads(spark.read.json(os.path.join(path, "_manifest")).first()["manifest"])
    out = {}
    for name, meta in manifest.items():
        df = spark.read.parquet(os.path.join(path, name))
        kind = meta.pop("kind")
        out[name] = (MapTable if kind == "MapTable" else RowsTable)(df, **meta)
    return out


def save_metadata(spark, path: str, threshold: float, train_through: str, test_month: str,
                  feature_config: str) -> None:
    """S6 metadata as a one-row table."""
    spark.createDataFrame([(float(threshold), train_through, test_month, feature_config)],
                          "threshold double, train_through_month string, test_month string, "
                          "feature_config string").write.mode("overwrite").parquet(path)


def load_threshold(spark, path: str, default: float = 0.5) -> float:
    """The saved threshold; ``default`` only where the metadata holds none.  A missing or
    unreadable folder is an error."""
    row = spark.read.parquet(path).first()
    found = row.asDict().get("threshold") if row else None
    return default if found is None else float(found)


def calibration_points(model: PriorCountModel, spark, n: int = 300, lo: float = 0.0,
                       hi: float = 7.0) -> DataFrame:
    """Model probability on an evenly spaced prior-count grid."""
    step = (hi - lo) / (n - 1)
    g = spark.range(n).select(F.col("id").alias(ROW_ID),
                              F.when(F.col("id") == n - 1, F.lit(hi))
                               .otherwise(F.col("id") * F.lit(step) + F.lit(lo)).alias(DEAL_COUNT_COL))
    p = model.predict_proba(g)
    return g.join(p, ROW_ID).select(F.col(DEAL_COUNT_COL).alias("prior_orders"), "proba")



# ---------------------------------------------------------------------------
# model persistence (S6) and the routed predictor (M4, M5)
# ---------------------------------------------------------------------------

def save_prior_model(m: PriorCountModel, path: str) -> None:
    _write_json(path, {"mean": m.scale.mean, "std": m.scale.std, "intercept": m.lr.intercept, "coefficients": list(m.lr.coefficients)})


def load_prior_model(spark, path: str) -> PriorCountModel:
    meta = _read_json(spark, path)
    return PriorCountModel(enc.ScaleStats(meta["mean"], meta["std"]), Line(meta["intercept"], tuple(meta["coefficients"])))


def save_full_model(m: FullFeatureModel, path: str) -> None:
    e = m.encoder
    m.lr.write().overwrite().save(os.path.join(path, "lr"))
    if e.index_model is not None:
        e.index_model.write().overwrite().save(os.path.join(path, "index"))
    for i, c in enumerate(e.fc.te_cols):
        e.te_maps[c].write.mode("overwrite").parquet(os.path.join(path, f"te_{i}"))
    fc = e.fc
    _write_json(path, {
        "fc": fc.to_dict(),
        "scale": {c: [s.mean, s.std] for c, s in e.scale.items()},
        "global_mean": e.global_mean, "names": e.names, "group_map": e.group_map,
        "has_index": e.index_model is not None, "kept": e.kept})


def load_full_model(spark, path: str) -> FullFeatureModel:
    from pyspark.ml.classification import LogisticRegressionModel
    meta = _read_json(spark, path)
    fc = FeatureColumns.from_dict(meta["fc"])
    index_model = PipelineModel.load(os.path.join(path, "index")) if meta["has_index"] else None
    te_maps = {c: spark.read.parquet(os.path.join(path, f"te_{i}")) for i, c in enumerate(fc.te_cols)}
    e = OrderEncoderModel(fc, index_model, {c: enc.ScaleStats(*v) for c, v in meta["scale"].items()},
                          te_maps, meta["global_mean"], meta["names"], meta["group_map"], meta.get("kept"))
    return FullFeatureModel(e, LogisticRegressionModel.load(os.path.join(path, "lr")))


def save_boosted_model(m: BoostedTreeModel, path: str) -> None:
    m.pipeline.write().overwrite().save(os.path.join(path, "trees"))
    _write_json(path, {"cat_cols": m.cat_cols, "num_cols": m.num_cols})


def load_boosted_model(spark, path: str) -> BoostedTreeModel:
    meta = _read_json(spark, path)
    return BoostedTreeModel(PipelineModel.load(os.path.join(path, "trees")), meta["cat_cols"], meta["num_cols"])


def _write_json(path: str, obj: dict) -> None:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(obj, ensure_ascii=False),)], "meta string") \
         .coalesce(1).write.mode("overwrite").json(os.path.join(path, "_meta"))


def _read_json(spark, path: str) -> dict:
    return json.loads(spark.read.json(os.path.join(path, "_meta")).first()["meta"])


class OrderOutcomePredictor:
    """Routed scorer over a saved folder: feature spec, contexts, metadata
    (threshold) and the two models.  ``predict_proba`` returns one
    probability per input row keyed by ``row_id``; ``predict`` adds the
    decision at the stored threshold."""

    def __init__(self, spark, data_dir: str, config: dict | None = None):
        from orderlens.plans.spec import load_feature_config
        self.spark = spark
        self.config = config or load_feature_config()
        self.contexts = load_contexts(spark, os.path.join(data_dir, "contexts"))
        self.threshold = load_threshold(spark, os.path.join(data_dir, "meta"))
        self.returning = load_prior_model(spark, os.path.join(data_dir, "model_returning"))
        self.new = load_full_model(spark, os.path.join(data_dir, "model_new"))

    @staticmethod
    def save(data_dir: str, contexts: dict, new_model: FullFeatureModel,
             returning_model: PriorCountModel, threshold: float, train_through: str,
             test_month: str, feature_config: str = "default") -> None:
        save_contexts(contexts, os.path.join(data_dir, "contexts"))
        save_full_model(new_model, os.path.join(data_dir, "model_new"))
        save_prior_model(returning_model, os.path.join(data_dir, "model_returning"))
        from pyspark.sql import SparkSession
        save_metadata(SparkSession.getActiveSession(), os.path.join(data_dir, "meta"), threshold,
                      train_through, test_month, feature_config)

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return route_and_score(df, self.config, self.contexts, self.new, self.returning,
                               self.threshold).select(ROW_ID, "route", "proba")

    def predict(self, df: DataFrame) -> DataFrame:
        return route_and_score(df, self.config, self.contexts, self.new, self.returning,
                               self.threshold)
