"""WoE encoding as a stage of a ``pyspark.ml`` pipeline: an estimator with parameters, and its model, both saved and loaded."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from riskframe.operators.woe import WoETransformer


class _WoEParams(HasLabelCol, HasOutputCol):
    """``labelCol`` is the 0/1 target; ``outputCol`` the vector of the encoded columns, none if empty."""

    inputCols = Param(Params._dummy(), "inputCols", "features to encode; all other columns of the fitted table if empty", TypeConverters.toListString)
    bins = Param(Params._dummy(), "bins", "quantile bins of a continuous feature", TypeConverters.toInt)
    ivThreshold = Param(Params._dummy(), "ivThreshold", "information value a feature must reach", TypeConverters.toFloat)
    topK = Param(Params._dummy(), "topK", "features kept at most, 0 for all", TypeConverters.toInt)
    epsilon = Param(Params._dummy(), "epsilon", "added to every count", TypeConverters.toFloat)
    suffix = Param(Params._dummy(), "suffix", "of the encoded columns' names", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", outputCol="", inputCols=[], bins=10, ivThreshold=0.02, topK=0, epsilon=0.0001, suffix="_woe")

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)

    def getBins(self) -> int:
        return self.getOrDefault(self.bins)

    def getIvThreshold(self) -> float:
        return self.getOrDefault(self.ivThreshold)

    def getTopK(self) -> int:
        return self.getOrDefault(self.topK)

    def getEpsilon(self) -> float:
        return self.getOrDefault(self.epsilon)

    def getSuffix(self) -> str:
        return self.getOrDefault(self.suffix)


class WoEEncoder(Estimator, _WoEParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits :class:`WoETransformer` on ``inputCols`` and ``labelCol``.

    The model adds a column ``<feature><suffix>`` for every selected feature, and the vector of them as ``outputCol``.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol="label", outputCol="", bins=10, ivThreshold=0.02, topK=0, epsilon=0.0001, suffix="_woe"):
        super().__init__()
        self.setParams(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setParams(self, **params) -> "WoEEncoder":
        return self._set(**params)

    def setIvThreshold(self, value: float) -> "WoEEncoder":
        return self._set(ivThreshold=value)

    def setTopK(self, value: int) -> "WoEEncoder":
        return self._set(topK=value)

    def _fit(self, dataset: DataFrame) -> "WoEEncoderModel":
        label = self.getLabelCol()
        names = self.getInputCols() or [c for c in dataset.columns if c != label]
        encoder = WoETransformer(
            label, self.getBins(), self.getIvThreshold(), self.getTopK() or None, self.getEpsilon(), cache_input=True
        ).fit(dataset.select(*names, label))
        return self._copyValues(WoEEncoderModel(encoder))


class WoEEncoderModel(Model, _WoEParams, MLWritable):
    """A fitted encoder. Rows need the selected features only; the label may be missing."""

    def __init__(self, encoder: WoETransformer | None = None):
        super().__init__()
        self.encoder = encoder

    @property
    def selectedFeatures(self) -> list[str]:
        return self.encoder.get_selected_features()

    @property
    def ivSummary(self) -> DataFrame:
        return self.encoder.get_iv_summary()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        encoded = self.encoder.encode(dataset, self.getSuffix())
        if not self.getOutputCol():
            return encoded
        names = [f + self.getSuffix() for f in self.selectedFeatures]
        if not names:
            raise ValueError(f"no feature reaches the information value {self.getIvThreshold()}, so there is nothing to assemble")
        return VectorAssembler(inputCols=names, outputCol=self.getOutputCol()).transform(encoded)

    def write(self) -> "MLWriter":
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> "MLReader":
        return _ModelReader(cls)

    @classmethod
    def load(cls, path: str) -> "WoEEncoderModel":
        return cls.read().load(path)


class _ModelWriter(MLWriter):
    def __init__(self, instance: WoEEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.encoder.save(f"{path}/encoder")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> WoEEncoderModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls(WoETransformer.load(spark, f"{path}/encoder"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
