"""A ledger of rows by key and time that grows with a stream, read without its history.

Each micro-batch writes a run. Every ``fan`` runs of a level are merged into one
of the next, without the rows that have expired. So the rows before any batch
are a handful of runs whose names follow from its number: nothing is listed but
those, and their number grows with the logarithm of the batches. A run is cut
into time slots and hash buckets; a batch reads the live slots of its own keys'
buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 16
BUCKETS = 16
_SLOT, _BUCKET = "slot", "bucket"


class Ledger:
    """Rows of ``schema`` with a ``key`` (NULL is one like any other) and a BIGINT time ``at``.

    ``slot`` is the width of a time slot in the unit of ``at``; 0 is one slot for
    all times. A run replaces its folder as a whole, and a batch reads only runs
    of earlier ones, so a batch that is run again leaves the same ledger. Runs
    that were merged are not deleted: how long they are kept is up to the folder.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, at: str,
        slot: int = 0, buckets: int = BUCKETS, fan: int = FAN,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.at, self.slot, self.buckets, self.fan = key, at, slot, buckets, fan
        self._stored = T.StructType(
            [*schema.fields, T.StructField(_SLOT, T.LongType()), T.StructField(_BUCKET, T.IntegerType())]
        )

    def write(self, df: DataFrame, epoch: int, since: int | None = None) -> None:
        """Add the rows of a batch; ``epoch`` -1 is what was there before the stream.

        Merges that fall due leave out rows with ``at`` of ``since`` or earlier.
        """
        run = epoch + 1
        self._write(df, 0, run)
        level, size = 1, self.fan
        while (run + 1) % size == 0:
            of = (run + 1) // size - 1
            parts = [self._run(level - 1, of * self.fan + i) for i in range(self.fan)]
            merged = reduce(DataFrame.unionByName, [p for p in parts if p is not None])
            if since is not None:
                merged = merged.filter(F.col(self.at) > since)
            self._write(merged, level, of)
            level, size = level + 1, size * self.fan

    def rows(self, before: int | None = None, since: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """Rows of the batches before ``before``, later than ``since``, in the buckets of ``keys``.

        ``keys`` has the key column; from it the driver learns which of the
        buckets are asked for. Rows of other keys in them are left in. Without
        ``before`` the runs of single batches are read, all there are.
        """
        if before is None:
            found = [self._read(f"{self.path}/level=0")]
        else:
            found = [self._run(level, run) for level, run in self._covering(before + 1)]
        asked = None
        if keys is not None:
            asked = [r[0] for r in keys.select(self._bucket()).distinct().collect()]
        parts = []
        for df in found:
            if df is None:
                continue
            if since is not None:
                df = df.filter(F.col(self.at) > since)
                if self.slot:
                    df = df.filter(F.col(_SLOT) >= since // self.slot)
            if asked is not None:
                df = df.filter(F.col(_BUCKET).isin(asked))
            parts.append(df.select(*self.schema.names))
        empty = self.spark.createDataFrame([], self.schema)
        return reduce(DataFrame.unionByName, parts) if parts else empty

    def _covering(self, count: int) -> Iterator[tuple[int, int]]:
        """The largest whole runs that make up the first ``count`` single ones."""
        level = 0
        while self.fan ** (level + 1) <= count:
            level += 1
        start = 0
        for k in range(level, -1, -1):
            size = self.fan**k
            while start + size <= count:
                yield k, start // size
                start += size

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, level: int, run: int) -> None:
        slot = F.floor(F.col(self.at) / F.lit(self.slot)) if self.slot else F.lit(0)
        placed = df.select(*self.schema.names, slot.cast("long").alias(_SLOT), self._bucket().alias(_BUCKET))
        (
            # Rows of a slot and bucket come together in files of a fair size.
            placed.hint("rebalance", _SLOT, _BUCKET)
            .write.mode("overwrite")
            .partitionBy(_SLOT, _BUCKET)
            # A look-up of single keys skips row groups that do not have them.
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .parquet(f"{self.path}/level={level}/run={run}")
        )

    def _run(self, level: int, run: int) -> DataFrame | None:
        """A run; None where the first one was never written. Any other that is missing is an error."""
        try:
            return self.spark.read.schema(self._stored).parquet(f"{self.path}/level={level}/run={run}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" or level or run:
                raise
            return None

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(self._stored).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
