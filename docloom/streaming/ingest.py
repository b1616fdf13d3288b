"""Incremental ingest: new files only, each chunk written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import append_new

FILES = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, folder: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """New binary files of a folder as a stream."""
    return spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", glob).load(folder)


def ingest(stream: DataFrame, to_chunks: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, keys: tuple[str, ...] = ("unique_id", "chunk_no")) -> StreamingQuery:
    """Runs to_chunks on each batch of the stream, and appends chunks whose keys the table doesn't have, until the source is read. A batch that runs again
    after a failure adds nothing twice."""

    def add(batch: DataFrame, _: int) -> None:
        append_new(to_chunks(batch), table, list(keys))

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
