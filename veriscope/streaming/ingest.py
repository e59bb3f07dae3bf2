"""Resumable ingest of landed page files into the evidence store.

``readStream`` over the landing folder (declared schema, ``maxFilesPerTrigger`` as
the page limit per micro-batch) + ``foreachBatch`` doing the store's
insert-if-absent.  The streaming checkpoint remembers which files were taken, so a
rerun adds nothing; a replayed micro-batch is harmless because the write skips
keys that are already stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from veriscope.sources.store import EvidenceStore


def ingest_pages(spark: SparkSession, landing: str, schema: StructType, store: EvidenceStore,
                 to_documents: Callable[[DataFrame], DataFrame], checkpoint: str,
                 max_files_per_trigger: int = 10, multiline: bool = False,
                 processing_time: str | None = None):
    """Take every landed file (``availableNow``) and return; with ``processing_time``
    (e.g. ``"1 minute"``) keep running and return the StreamingQuery instead."""
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("multiLine", multiline)
              .option("mode", "DROPMALFORMED")
              .option("pathGlobFilter", "*.json")
              .json(landing))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        store.write_documents(to_documents(batch))      # writes the keyed batch first: pages are parsed once

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return None
