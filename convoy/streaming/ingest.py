"""Incremental ingestion of file drops into keyed tables with Structured Streaming.

``readStream`` picks up new files of a folder; every micro-batch is merged into the keyed
table with the latest-row-wins upsert.  The upsert is idempotent (the same batch twice gives
the same table), so a micro-batch replayed after a failure, which ``foreachBatch`` may do,
leaves the table exactly as one delivery would.  Progress is kept in ``checkpoint`` (shared
storage on a cluster).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from convoy.operators.tables import TableSpec, write_table


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    fmt: str = "csv",
    options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame over the files arriving in ``folder`` (schema is required)."""
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(folder)


def upsert_stream(
    stream: DataFrame,
    spec: TableSpec,
    table_path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Merge every micro-batch of ``stream`` (after ``transform``) into the keyed table."""

    def merge(batch: DataFrame, epoch_id: int) -> None:
        rows = transform(batch) if transform else batch
        write_table(rows, spec, table_path, "upsert")

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
