"""The label encoder as a pipeline stage that is saved with its model (FT1, PR1).

``LexicalEncoder`` learns the lexicographic code of every value of its columns
(``transforms.label_codes``: ranked in range order, no column's values in one
task).  The codes are a table, not a parameter: the fitted stage joins them, and
is saved as its parameters and that table, so that a ``PipelineModel`` that holds
it gives the same codes in another session.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopcast.operators import transforms as T
from stopcast.sources.files import shared_path

CODES = "name string, __v string, __code int"


class _EncoderParams(HasInputCols):
    suffix = Param(Params._dummy(), "suffix", "appended to a column's name for its code", TypeConverters.toString)
    unseen = Param(Params._dummy(), "unseen", "code of values that were not learned: 'null' or 'minus_one'", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(suffix="_code", unseen="null")


class LexicalEncoder(_EncoderParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<column><suffix>`` (double): the rank of the value's string form among
    those learned; null counts as the value ``nan``."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, suffix: str = "_code", unseen: str = "null"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LexicalEncoderModel:
        if self.getOrDefault("unseen") not in ("null", "minus_one"):
            raise ValueError("unseen: 'null' or 'minus_one'")
        path = shared_path(dataset.sparkSession, "codes")
        T.label_codes(dataset, self.getInputCols()).write.parquet(path)
        model = LexicalEncoderModel()
        model.codes = dataset.sparkSession.read.schema(CODES).parquet(path)
        return self._copyValues(model)


class LexicalEncoderModel(_EncoderParams, Model, MLReadable, MLWritable):
    """The learned codes, joined to the columns."""

    codes: DataFrame

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        unseen = F.lit(None if self.getOrDefault("unseen") == "null" else -1.0).cast("double")
        for c in self.getInputCols():
            own = self.codes.where(F.col("name") == c).select(F.col("__v").alias("__known"), F.col("__code").alias("__rank"))
            out = (out.withColumn("__v", F.coalesce(F.col(c).cast("string"), F.lit(T.NULL_TOKEN)))
                   .join(own, F.col("__v") == F.col("__known"), "left")
                   .withColumn(c + self.getOrDefault("suffix"), F.coalesce(F.col("__rank").cast("double"), unseen))
                   .drop("__v", "__known", "__rank"))
        return out

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader()


class _CodesWriter(MLWriter):
    def __init__(self, instance: LexicalEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.codes.write.parquet(f"{path.rstrip('/')}/codes")


class _CodesReader(MLReader):
    def load(self, path: str) -> LexicalEncoderModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = LexicalEncoderModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.codes = spark.read.schema(CODES).parquet(f"{path.rstrip('/')}/codes")
        return model
