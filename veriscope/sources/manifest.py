"""Tables that are appended in named batches, each of them once.

A batch is written to a folder of its own and then named in the manifest by one small
append.  Readers open only folders in the manifest.  A run that dies before the
manifest is written leaves a folder that nobody reads; a repeated run finds its batch
named and adds nothing; of two runs that name one batch, the first folder by name counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

NAMED = "batch string, folder string, n_rows long"


class BatchTable:
    """Rows of committed batches under ``path``; ``schema`` is that of the rows."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def batches(self) -> DataFrame:
        """(batch, folder, n_rows) of committed batches."""
        try:
            named = self.spark.read.schema(NAMED).parquet(f"{self.path}/manifest")
        except AnalysisException:                            # nothing committed yet
            return self.spark.createDataFrame([], NAMED)
        return named.groupBy("batch").agg(F.min(F.struct("folder", "n_rows")).alias("m")).select("batch", "m.*")

    def committed(self) -> set[str]:
        """Names of batches (one a unit of work, not a row)."""
        return {r["batch"] for r in self.batches().select("batch").collect()}

    def stage(self, rows: DataFrame, batch: str) -> tuple[str, int]:
        """Write a batch where no reader looks; returns its folder and row count."""
        folder = f"staged-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{folder}")
        return folder, self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{folder}").count()

    def commit(self, batch: str, folder: str, n_rows: int) -> None:
        row = self.spark.createDataFrame([(batch, folder, n_rows)], NAMED)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def append(self, batch: str, make: Callable[[], DataFrame]) -> bool:
        """Stage and commit a batch unless it is there already; ``make`` is not called then."""
        if batch in self.committed():
            return False
        self.commit(batch, *self.stage(make(), batch))
        return True

    def read(self) -> DataFrame:
        folders = [f"{self.path}/data/{r['folder']}" for r in self.batches().where("n_rows > 0").select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)
