"""The modelling steps as ``pyspark.ml`` stages, to be fitted, saved and loaded as one pipeline.

``Pipeline(stages=[FillMissing, OneHotFrame, BalancedBoosting, ThresholdLabel])`` is fitted on labelled rows.
Fill statistics, the categories' dictionary (a table, saved as one), the boosted trees and the threshold are
part of the saved model, so a loaded one scores a batch exactly as the fitted one does.  Oversampling happens
while fitting and leaves no stage behind: scored rows are never resampled.
"""
from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.ml import evaluate as E
from tessera.ml.dictionary import dictionary
from tessera.ml.onehot import sparse_frame
from tessera.ml.prepare import column_stats
from tessera.ml.train import balanced
from tessera.ml.trees import FEATURES, LABEL, gbt
from tessera.session import checkpoint


class _Columns(Params):
    numeric = Param(Params._dummy(), "numeric", "columns of numbers", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "columns of categories", TypeConverters.toListString)


class FillMissing(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Initial fill: means of numbers, most frequent values of categories (of equal ones the smallest)."""

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FilledMissing:
        numeric, categorical = self.getOrDefault(self.numeric), self.getOrDefault(self.categorical)
        return FilledMissing(numeric=numeric, categorical=categorical, fills=json.dumps(column_stats(dataset, numeric, categorical)))


class FilledMissing(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "value for the nulls of each column, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None, fills=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = json.loads(self.getOrDefault(self.fills))
        kinds = {c: "double" for c in self.getOrDefault(self.numeric)} | {c: "string" for c in self.getOrDefault(self.categorical)}
        return dataset.withColumns({c: F.coalesce(F.col(c).cast(kind), F.lit(fills[c]).cast(kind)) for c, kind in kinds.items()})


class OneHotFrame(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers and categories to the sparse vector ``features``."""

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> OneHotFrameModel:
        numeric, categorical = self.getOrDefault(self.numeric), self.getOrDefault(self.categorical)
        model = OneHotFrameModel(numeric=numeric, categorical=categorical)
        model.codes = checkpoint(dictionary(dataset, categorical)) if categorical else None
        return model


class _WithCodes(MLWriter):
    def __init__(self, model: OneHotFrameModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        if self.model.codes is not None:
            self.model.codes.write.parquet(f"{path}/codes")


class _ReadCodes(MLReader):
    def load(self, path: str) -> OneHotFrameModel:
        model = OneHotFrameModel()
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        if model.getOrDefault(model.categorical):
            model.codes = self.sparkSession.read.parquet(f"{path}/codes")
        return model


class OneHotFrameModel(Model, _Columns, MLReadable, MLWritable):
    """A category that was not there when fitting has no slot.  Transforming stages the frame (``tessera.ml.onehot``); the
    columns themselves stay."""

    codes: DataFrame | None = None

    @keyword_only
    def __init__(self, *, numeric=None, categorical=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def write(self) -> MLWriter:
        return _WithCodes(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ReadCodes()

    def copy(self, extra=None) -> OneHotFrameModel:
        that = super().copy(extra)
        that.codes = self.codes
        return that

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numeric, categorical = self.getOrDefault(self.numeric), self.getOrDefault(self.categorical)
        doubled = dataset.select("*", *[F.col(c).alias(f"__{c}") for c in (*numeric, *categorical)])
        codes = self.codes
        if codes is not None:
            codes = codes.withColumn("column", F.concat(F.lit("__"), "column"))
        return sparse_frame(doubled, [f"__{c}" for c in numeric], [f"__{c}" for c in categorical], codes, FEATURES)[0]


class BalancedBoosting(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """ADASYN of the smaller class, then boosted trees; fitting gives the trees' model alone."""

    idCol = Param(Params._dummy(), "idCol", "row id", TypeConverters.toString)
    targetCol = Param(Params._dummy(), "targetCol", "the standardised result", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "point of the parameter grid, as JSON", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "boosting rounds", TypeConverters.toInt)
    k = Param(Params._dummy(), "k", "neighbours of a sample", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, idCol=None, targetCol=None, settings="{}", maxIter=100, k=5, seed=0):
        super().__init__()
        self._setDefault(settings="{}", maxIter=100, k=5, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        at = self.getOrDefault
        rows = dataset.where(F.col(at(self.targetCol)).isNotNull()).withColumn(LABEL, (F.col(at(self.targetCol)) == E.POS).cast("double"))
        train = balanced(rows, at(self.idCol), at(self.k), at(self.seed))
        return gbt(json.loads(at(self.settings)), at(self.maxIter), at(self.seed)).fit(train)


class ThresholdLabel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``p_pass`` and the label by the strict threshold, in place of the trees' own columns."""

    threshold = Param(Params._dummy(), "threshold", "pass if p_pass is above", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, threshold=0.5):
        super().__init__()
        self._setDefault(threshold=0.5)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.withColumn("p_pass", vector_to_array("probability")[1])
        return out.withColumn("prediction", E.threshold_label(F.col("p_pass"), self.getOrDefault(self.threshold))).drop(
            "probability", "rawPrediction", FEATURES)


def inspection_pipeline(id_col: str, target: str, numeric: list[str], categorical: list[str], settings: dict | None = None,
                        threshold: float = 0.5, max_iter: int = 100, k: int = 5, seed: int = 0) -> Pipeline:
    """fill -> one-hot -> oversample and boost -> threshold."""
    return Pipeline(stages=[
        FillMissing(numeric=numeric, categorical=categorical), OneHotFrame(numeric=numeric, categorical=categorical),
        BalancedBoosting(idCol=id_col, targetCol=target, settings=json.dumps(settings or {}), maxIter=max_iter, k=k, seed=seed),
        ThresholdLabel(threshold=threshold)])
