"""A history table in files, in which a snapshot never rewrites what is closed.

Each snapshot has a folder of its own, with the versions it closed and all that are open
after it apart. A log names the snapshots that were written to the end. Reading takes the
closed versions of all of them, and the open ones of the last; the files of earlier
snapshots are never written again, and an unfinished snapshot is not seen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.scd2 import CHECKED, changed_versions, first_snapshot

_LOG = "snapshot string, taken_at timestamp_ntz"


class HistoryStore:
    """The history of records by ``key`` below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark, self.folder, self.key = spark, folder, key

    def snapshots(self) -> list[str]:
        """The finished snapshots, in order: a row of the log for each."""
        try:
            rows = self.spark.read.schema(_LOG).parquet(f"{self.folder}/_log").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({r.snapshot for r in rows})

    def _rows(self) -> DataFrame:
        last = self.snapshots()[-1]
        data = self.spark.read.parquet(f"{self.folder}/versions/snapshot={last}")
        named = [T.StructField("snapshot", T.StringType()), T.StructField("state", T.StringType())]
        columns = [f for f in data.schema.fields if f.name != "state"]
        return self.spark.read.schema(T.StructType([*columns, *named])).parquet(f"{self.folder}/versions")

    def open_rows(self) -> DataFrame:
        last = self.snapshots()[-1]
        return self._rows().where((F.col("state") == "open") & (F.col("snapshot") == last)).drop("snapshot", "state")

    def read(self) -> DataFrame:
        """All versions; only folders of finished snapshots are listed."""
        done = self.snapshots()
        closed = (F.col("state") == "closed") & F.col("snapshot").isin(done)
        still = (F.col("state") == "open") & (F.col("snapshot") == done[-1])
        return self._rows().where(closed | still).drop("snapshot", "state")

    def take(self, incoming: DataFrame, at: dt.datetime, checked: tuple[str, ...] = CHECKED) -> None:
        """Take a snapshot of the records as they are at ``at``, later than all before. A
        snapshot that was taken already is left as it is."""
        done, name = self.snapshots(), f"{at:%Y%m%dT%H%M%S}"
        if name in done:
            return
        if done and name < done[-1]:
            raise ValueError(f"there is a later snapshot than {at}: {done[-1]}")
        if done:
            rows = changed_versions(self.open_rows(), incoming, self.key, at, checked)
        else:
            rows = first_snapshot(incoming, self.key, at)
        state = F.when(F.col("dbt_valid_to").isNull(), "open").otherwise("closed")
        rows.withColumn("state", state).write.mode("overwrite").partitionBy("state").parquet(
            f"{self.folder}/versions/snapshot={name}"
        )
        entry = self.spark.createDataFrame([(name, at)], _LOG)
        entry.coalesce(1).write.mode("append").parquet(f"{self.folder}/_log")
