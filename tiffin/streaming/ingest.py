"""Landing files to an append-only bronze table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiffin.sources.landing import METADATA, RESCUED, stream, with_metadata


class BronzeStream:
    """One landing folder, one bronze table, one checkpoint next to the table.

    The checkpoint remembers which files were read and the sink's own log which files were
    committed, so every landing file is ingested exactly once. To ingest again, take a new folder:
    a table without its checkpoint, or the reverse, would be wrong.
    """

    def __init__(self, spark: SparkSession, landing: str, root: str, columns: list[str],
                 kind: str = "json", max_files: int = 8):
        if root.startswith(landing.rstrip("/") + "/"):
            raise ValueError("the table and its checkpoint must lie outside the landing folder")
        self.spark, self.landing, self.columns = spark, landing, columns
        self.kind, self.max_files = kind, max_files
        self.path, self.checkpoint = f"{root}/table", f"{root}/checkpoint"

    def source(self) -> DataFrame:
        return stream(self.spark, self.landing, self.columns, self.kind, self.max_files)

    def _writer(self, batch_id: str):
        return (with_metadata(self.source(), batch_id).writeStream.format("parquet")
                .outputMode("append").option("checkpointLocation", self.checkpoint)
                .option("path", self.path))

    def schema(self) -> str:
        meta = {METADATA[0]: "timestamp"}
        return ", ".join(f"`{c}` {meta.get(c, 'string')}"
                         for c in [*self.columns, RESCUED, *METADATA])

    def read(self) -> DataFrame:
        """Committed rows; empty before the first run."""
        try:
            return self.spark.read.schema(self.schema()).parquet(self.path)
        except AnalysisException as exc:  # nothing was ingested yet
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return self.spark.createDataFrame([], self.schema())

    def ingest_once(self, batch_id: str) -> int:
        """Everything that is new, then stop. Gives the rows added by the table's own count of this
        batch id; a file holds one id, so the others are skipped by their statistics."""
        def held() -> int:
            return self.read().filter(F.col("_bronze_batch_id") == batch_id).count()
        before = held()
        query = self._writer(batch_id).trigger(availableNow=True).start()
        query.awaitTermination()
        return held() - before

    def start(self, batch_id: str, interval: str = "10 seconds") -> StreamingQuery:
        """The same query without end; the caller stops it."""
        return self._writer(batch_id).trigger(processingTime=interval).start()
