"""A pipeline stage that tunes the decision threshold to the event rate."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .metrics import tuned_threshold


def positive_score(df: DataFrame, col: str) -> Column:
    """The score itself, or the last entry of a probability vector or array."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.NumericType):
        return F.col(col).cast("double")
    values = F.col(col) if isinstance(kind, T.ArrayType) else vector_to_array(F.col(col))
    return F.element_at(values, -1).cast("double")


class _Columns(HasInputCol, HasOutputCol, HasPredictionCol):
    """Shared columns: probability in, score and 0/1 prediction out."""

    def setInputCol(self, value: str):
        return self._set(inputCol=value)

    def setOutputCol(self, value: str):
        return self._set(outputCol=value)

    def setPredictionCol(self, value: str):
        return self._set(predictionCol=value)


class TunedThreshold(Estimator, _Columns, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the score percentile that calls as many rows positive as there are positives.

    The scores stay distributed; one number reaches the driver.
    """

    mode = Param(Params._dummy(), "mode", "'intended' ranks scores, 'strict' ranks labels",
                 TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, labelCol=None, predictionCol=None, outputCol=None, mode=None):
        super().__init__()
        self._setDefault(mode="intended")
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCol=None, labelCol=None, predictionCol=None, outputCol=None, mode=None):
        return self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setLabelCol(self, value: str):
        return self._set(labelCol=value)

    def setMode(self, value: str):
        return self._set(mode=value)

    def _fit(self, dataset: DataFrame) -> "TunedThresholdModel":
        scored = dataset.select(
            F.col(self.getLabelCol()).alias("label"),
            positive_score(dataset, self.getInputCol()).alias("score"),
        )
        found = tuned_threshold(scored, "label", "score", self.getOrDefault(self.mode)).first()
        if found["threshold"] is None:
            raise ValueError("cannot tune a threshold without labelled rows")
        model = TunedThresholdModel(tunedThreshold=found["threshold"])
        return self._copyValues(model)


class TunedThresholdModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the score and ``score >= threshold`` as Column expressions."""

    tunedThreshold = Param(Params._dummy(), "tunedThreshold", "lowest score called positive",
                           TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, predictionCol=None, outputCol=None, tunedThreshold=None):
        super().__init__()
        self.setParams(**self._input_kwargs)

    @keyword_only
    def setParams(self, *, inputCol=None, predictionCol=None, outputCol=None, tunedThreshold=None):
        return self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setTunedThreshold(self, value: float):
        return self._set(tunedThreshold=value)

    def getTunedThreshold(self) -> float:
        return self.getOrDefault(self.tunedThreshold)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score, called = self.getOutputCol(), self.getPredictionCol()
        scored = dataset.drop(called).withColumn(score, positive_score(dataset, self.getInputCol()))
        return scored.withColumn(
            called, F.when(F.col(score) >= self.getTunedThreshold(), 1).otherwise(0)
        )
