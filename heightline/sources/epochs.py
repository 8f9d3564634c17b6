"""Parquet tables written one micro-batch at a time.

Each micro-batch owns the folder ``epoch=N`` and replaces it as a whole, so a
batch that is run again after a failure leaves the same table behind.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "epoch"


class EpochTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def write(self, df: DataFrame, epoch: int) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(epoch))

    def epoch(self, epoch: int) -> DataFrame:
        """The rows of one epoch; none for a negative one, an error if its folder is not there."""
        if epoch < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(epoch))

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows, or those of epochs before ``before`` (other folders are not read)."""
        with_epoch = T.StructType([*self.schema.fields, T.StructField(EPOCH, T.LongType())])
        df = self._read(self.path, with_epoch)
        if before is not None:
            df = df.filter(F.col(EPOCH) < before)
        return df.drop(EPOCH)

    def _folder(self, epoch: int) -> str:
        return f"{self.path}/{EPOCH}={epoch}"

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
