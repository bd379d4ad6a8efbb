"""An upsert table in plain Parquet: a folder for each micro-batch, the newest row per key on reading.

Layout: ``run=<name>/batch=<n>/`` holds the rows of a micro-batch, and ``run=<name>/fold=<n>/`` the
newest row per key over the batches of the run up to ``n``. A run is a checkpoint that counts its
batches from 0. Every row holds its batch, so that it compares the same wherever it is stored: a
row in a batch and in a fold is one row for a reader. A folder counts once Spark has marked it as
complete, so a lost driver or executor leaves no half batch in view.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from touchline.operators.recent import latest_per_key
from touchline.sources import files

BATCH = "batch"
FOLD = "fold"
RUN = "run"

Needed = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class KeyedLog:
    """Upsert table: the newest row per key by ``order``, then by batch."""

    path: str
    schema: StructType
    key: tuple[str, ...]
    order: tuple[str, ...] = ()

    @property
    def _stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(BATCH, LongType())])

    def _folders(self, spark: SparkSession, kind: str, run: str = "*") -> list[str]:
        markers = files.glob(spark, f"{self.path}/{RUN}={run}/{kind}=*/_SUCCESS")
        return [marker.rsplit("/", 1)[0] for marker in markers]

    def write_batch(self, rows: DataFrame, batch_id: int, run: str = "v1") -> bool:
        """Write one micro-batch; False when a replay finds it complete."""
        target = f"{self.path}/{RUN}={run}/{BATCH}={batch_id}"
        if files.exists(rows.sparkSession, f"{target}/_SUCCESS"):
            return False
        numbered = rows.select(*self.schema.fieldNames(), F.lit(batch_id).cast("long").alias(BATCH))
        numbered.write.mode("overwrite").parquet(target)
        return True

    def _rows(self, spark: SparkSession, run: str = "*") -> DataFrame:
        folders = [*self._folders(spark, FOLD, run), *self._folders(spark, BATCH, run)]
        if not folders:
            return spark.createDataFrame([], self._stored)
        return spark.read.schema(self._stored).parquet(*folders)

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.key, [*self.order, BATCH], keep_order=True)

    def read(self, spark: SparkSession, needed: Needed = lambda rows: rows) -> DataFrame:
        """One row per key: the greatest by ``order``, then by batch.

        ``needed`` picks stored rows by their key alone, so it comes before older rows go.
        """
        return self._latest(needed(self._rows(spark))).select(*self.schema.fieldNames())

    def compact(
        self,
        spark: SparkSession,
        run: str,
        needed: Needed = lambda rows: rows,
    ) -> None:
        """Fold the batches of a run into one folder, with what is ``needed`` of them, by key alone.

        What the fold before this one stands for goes now, so a reader that has listed the
        folders before this fold was there still finds all of them.
        """
        number = {f: int(f.rsplit("=", 1)[1]) for k in (FOLD, BATCH) for f in self._folders(spark, k, run)}
        folds = [n for f, n in number.items() if f"/{FOLD}=" in f]
        last, before = max(number.values(), default=-1), max(folds, default=-1)
        if last == before:
            return
        rows = self._latest(needed(self._rows(spark, run))).select(*self._stored.fieldNames())
        rows.write.mode("overwrite").parquet(f"{self.path}/{RUN}={run}/{FOLD}={last}")
        for folder, n in number.items():
            if n < before or (n == before and f"/{BATCH}=" in folder):
                files.delete(spark, folder)

    def truncate(self, spark: SparkSession) -> None:
        """Remove every row of the table."""
        files.delete(spark, self.path)
