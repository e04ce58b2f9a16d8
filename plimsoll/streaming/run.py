"""Streams over stored tables, run until all that is there has been read."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources.reports import absent
from ..sources.stage import shared_folder


def table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stored Parquet table, a file or a folder of files, as a stream of its files.

    The path is given as a pattern that only it matches: a stream's plain path must be a folder.
    """
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder for one stream's output and state, among the shared ones."""
    return f"{shared_folder(spark).rstrip('/')}/plimsoll/streams/{name}-{uuid.uuid4().hex}"


def drain(stream: DataFrame, folder: str) -> DataFrame:
    """Runs the stream over all input that is there now and returns everything it has ever written to ``folder``.

    Offsets and state are kept beside the rows, so a later call with the same folder takes up where
    this one ended, whether it ended or was lost: files that were read are not read again, and the
    sink's log hides what an unfinished batch has left behind.
    """
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def drain_batches(stream: DataFrame, folder: str, write: Callable[[DataFrame, int], None], rows: str,
                  schema: str) -> DataFrame:
    """As :func:`drain`, for a writer of whole batches that keeps what it writes below ``rows``."""
    query = stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{folder}/state")
    query.trigger(availableNow=True).start().awaitTermination()
    spark = stream.sparkSession
    try:
        return spark.read.schema(schema).parquet(rows)
    except AnalysisException as e:
        if not absent(e):
            raise
        return spark.createDataFrame([], schema)  # no batch so far
