"""Incremental ingest of landing CSV files into a Bronze table.

A text stream over the ``*.csv`` files below the landing folder; its checkpoint records which files
were taken, so a rerun without new files runs no batch. Each micro-batch finds the headers of its
files, adds columns that are new to the table's schema log, and writes its rows to
``query=<id>/batch=<n>/``. The id is that of the checkpoint, so a batch that is repeated after a failure
overwrites its own folder, and batches of another checkpoint never meet it.
"""

from __future__ import annotations

import json
import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from obslake.session import scratch_path
from obslake.sources.landing import LINEAGE_FIELDS, landing_rows, lines_of, staged_headers
from obslake.streaming import schema_log


@dataclass(frozen=True)
class IngestedBatch:
    """What one micro-batch did."""

    batch: int
    files: int
    rows: int
    rescued_rows: int
    columns: int
    duration_ms: int


@dataclass
class BatchLog(StreamingQueryListener):
    """Duration of every batch of one query, by batch number (``lastProgress`` has only the last)."""

    durations: dict[int, int] = field(default_factory=dict)
    query_id: str | None = None
    ended: threading.Event = field(default_factory=threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query_id and event.progress.numInputRows:
            self.durations[event.progress.batchId] = event.progress.batchDuration

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.ended.set()


def schema_folder(bronze_path: str) -> str:
    """Where a Bronze table keeps its columns (a name that Spark's readers pass over)."""
    return f"{bronze_path.rstrip('/')}/_schema"


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that a checkpoint belongs to; it stays the same over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def new_lines(spark: SparkSession, landing: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Lines of the files that the checkpoint has not seen."""
    return lines_of(
        spark.readStream.format("text")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .load(landing)
    )


def ingest_batch(lines: DataFrame, batch: int, query_id: str, bronze_path: str) -> dict[str, int]:
    """Write the rows of one batch of lines; returns its counts."""
    spark = lines.sparkSession
    headers, distinct = staged_headers(lines, scratch_path(spark, "landing-headers"))
    columns = schema_log.extend(spark, schema_folder(bronze_path), distinct)
    seen = Observation()
    rescued = F.count("_rescued_data").alias("rescued_rows")
    rows = landing_rows(lines, headers, distinct, columns).observe(seen, F.count(F.lit(1)).alias("rows"), rescued)
    rows.write.mode("overwrite").parquet(f"{bronze_path.rstrip('/')}/query={query_id}/batch={batch}")
    return {"files": headers.count(), "columns": len(columns), **seen.get}


def run_bronze(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    checkpoint: str,
    query_name: str | None = "bronze_ingest",
    max_files_per_trigger: int = 1000,
) -> list[IngestedBatch]:
    """Process every file not seen before, then stop; returns what each batch did (none: caught up)."""
    done: dict[int, dict[str, int]] = {}

    def write(lines: DataFrame, batch: int) -> None:
        done[batch] = ingest_batch(lines, batch, checkpoint_id(spark, checkpoint), bronze_path)

    writer = (
        new_lines(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    log = BatchLog()
    spark.streams.addListener(log)
    try:
        query = (writer.queryName(query_name) if query_name else writer).start()
        log.query_id = query.id
        query.awaitTermination()
        log.ended.wait(10)  # the listener hears of the last batch a little later
    finally:
        spark.streams.removeListener(log)
    return [IngestedBatch(batch=n, duration_ms=log.durations.get(n, 0), **counts) for n, counts in sorted(done.items())]


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Bronze rows of every batch under the columns of the schema log; a column that a batch did not
    know is null in it."""
    version, columns = schema_log.known_columns(spark, schema_folder(bronze_path))
    if not version:
        raise FileNotFoundError(f"{bronze_path} has no ingested batch")
    schema = StructType([*[StructField(c, StringType()) for c in columns], *LINEAGE_FIELDS])
    return spark.read.schema(schema).parquet(bronze_path).select(*[f"`{f.name}`" for f in schema])
