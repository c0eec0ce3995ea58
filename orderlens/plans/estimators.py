"""The encoder and the models as ``pyspark.ml`` stages (X3, E6, M2, M3, S6): they fit in a
``Pipeline``, and what they fit is saved and loaded with it.
"""

from __future__ import annotations

import json
import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import encode as enc
from orderlens.plans import models as mdl
from orderlens.plans.features import FeatureColumns
from orderlens.schema import TARGET
from orderlens.session import stage_table


class _EncoderParams(Params):
    roles = Param(Params._dummy(), "roles", "feature roles as JSON (FeatureColumns.to_dict)", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "target column, 0 or 1", TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "column of folds; rows with a fold are training rows", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(target=TARGET, foldCol="fold")

    @property
    def columns(self) -> FeatureColumns:
        return FeatureColumns.from_dict(json.loads(self.getOrDefault(self.roles)))


class OrderEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot slots, scaled numbers, flags and smoothed target encodings as ``features``.

    A ``Pipeline`` transforms its training rows with the fitted stage; those have a fold and get
    encodings from the other folds, as at a fit they must.  Rows without a fold, or a table
    without that column, get the encodings of all training rows."""

    @keyword_only
    def __init__(self, *, roles: str | None = None, target: str = TARGET, foldCol: str = "fold"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, fc: FeatureColumns, **more) -> OrderEncoder:
        return cls(roles=json.dumps(fc.to_dict(), ensure_ascii=False), **more)

    def _fit(self, dataset: DataFrame) -> OrderEncoderStage:
        fc, target, fold = self.columns, self.getOrDefault(self.target), self.getOrDefault(self.foldCol)
        fitted = mdl.fit_encoder(dataset, fc, target)
        others = {}
        if fold in dataset.columns:
            for c in fc.te_cols:
                table = enc.oof_map(dataset.where(F.col(f"`{fold}`").isNotNull()), c, target, fold, fc.te_alpha[c], fitted.global_mean)
                others[c] = stage_table(table, "oof_map")
        return self._copyValues(OrderEncoderStage(fitted, others))


class OrderEncoderStage(Model, _EncoderParams, MLWritable, MLReadable):
    """A fitted :class:`OrderEncoder`."""

    def __init__(self, fitted: mdl.OrderEncoderModel | None = None, others: dict | None = None):
        super().__init__()
        self.fitted, self.others = fitted, others or {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted, fold = self.fitted, self.getOrDefault(self.foldCol)
        out, te = fitted._base(dataset), []
        heavy = {}
        if fitted.fc.te_cols:
            from orderlens.operators.lookups import heavy_values
            heavy = heavy_values(dataset, fitted.fc.te_cols)
        for i, c in enumerate(fitted.fc.te_cols):
            te.append(f"__te_{i}")
            out = enc.apply_target_map(out, c, fitted.te_maps[c], fitted.global_mean, te[-1], heavy[c])
            if c in self.others and fold in dataset.columns:
                out = enc.apply_oof(out, c, fold, self.others[c], fitted.global_mean, "__oof", heavy[c])
                out = out.withColumn(te[-1], F.when(F.col(f"`{fold}`").isNotNull(), F.col("__oof")).otherwise(F.col(te[-1]))).drop("__oof")
        out = fitted._assemble(out, te)
        made = [c for c in out.columns if c.startswith(("__cat_", "__num_", "__bin_", "__idx_", "__oh_", "__te_")) and c not in dataset.columns]
        return out.drop(*made)

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader()


class _StageWriter(MLWriter):
    def __init__(self, stage: OrderEncoderStage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:  # noqa: N802
        e, fc = self.stage.fitted, self.stage.fitted.fc
        found = {"scale": {c: [s.mean, s.std] for c, s in e.scale.items()}, "global_mean": e.global_mean, "names": e.names,
                 "group_map": e.group_map, "kept": e.kept, "index": e.index_model is not None, "others": bool(self.stage.others)}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"fitted": found})
        if e.index_model is not None:
            e.index_model.write().save(os.path.join(path, "index"))
        for i, c in enumerate(fc.te_cols):
            e.te_maps[c].write.parquet(os.path.join(path, f"te_{i}"))
            if c in self.stage.others:
                self.stage.others[c].write.parquet(os.path.join(path, f"oof_{i}"))


class _StageReader(MLReader):
    def load(self, path: str) -> OrderEncoderStage:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = OrderEncoderStage()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        fc, found = stage.columns, metadata["fitted"]
        table = lambda name: self.sparkSession.read.parquet(os.path.join(path, name))
        index = PipelineModel.load(os.path.join(path, "index")) if found["index"] else None
        maps = {c: table(f"te_{i}") for i, c in enumerate(fc.te_cols)}
        scale = {c: enc.ScaleStats(*v) for c, v in found["scale"].items()}
        stage.fitted = mdl.OrderEncoderModel(fc, index, scale, maps, found["global_mean"], found["names"], found["group_map"], found["kept"])
        stage.others = {c: table(f"oof_{i}") for i, c in enumerate(fc.te_cols)} if found["others"] else {}
        return stage


class BalancedLogistic(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M1, M2: ``features`` -> logistic regression with balanced class weights and strength ``c``."""

    target = Param(Params._dummy(), "target", "target column, 0 or 1", TypeConverters.toString)
    c = Param(Params._dummy(), "c", "inverse strength of the penalty", TypeConverters.toFloat)
    tol = Param(Params._dummy(), "tol", "tolerance of the solver", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, target: str = TARGET, c: float = 1.0, tol: float = 1e-4):
        super().__init__()
        self._setDefault(target=TARGET, c=1.0, tol=1e-4)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        target = self.getOrDefault(self.target)
        n, p = mdl.class_counts(dataset, target)
        weighted = dataset.withColumn("__w", mdl.class_weights(dataset, target, (n, p)))
        fit = mdl.logistic("__w", mdl.balanced_weights(n, p)[2], self.getOrDefault(self.c), tol=self.getOrDefault(self.tol))
        return fit.setLabelCol(target).fit(weighted)


class BoostedTrees(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """M3: indexed categories and numbers -> boosted trees with balanced class weights; fits to a
    ``PipelineModel``."""

    catCols = Param(Params._dummy(), "catCols", "category columns", TypeConverters.toListString)
    numCols = Param(Params._dummy(), "numCols", "number columns", TypeConverters.toListString)
    maxIter = Param(Params._dummy(), "maxIter", "trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "depth of a tree", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "step size", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, catCols: list | None = None, numCols: list | None = None, maxIter: int = 500, depth: int = 4,
                 step: float = 0.03, seed: int = 42):
        super().__init__()
        self._setDefault(catCols=[], numCols=[], maxIter=500, depth=4, step=0.03, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        get = self.getOrDefault
        return mdl.BoostedTreeModel.fit(dataset, get(self.catCols), get(self.numCols), get(self.maxIter), get(self.depth),
                                        get(self.step), seed=get(self.seed)).pipeline
