"""Provenance columns put on every row as it is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.schemas import (
    PROCESSED_DATE,
    PROCESSING_TIME,
    SOURCE_FILE,
    SOURCE_SIZE,
    SOURCE_TIME,
)


def source_file() -> Column:
    """Address of the file a row was read from, percent-encoded as Spark gives it.

    The hidden `_metadata` struct is used throughout: unlike `input_file_name()` it is an ordinary
    column, so it stays right under joins, and both forms must never be mixed as a join key.
    """
    return F.col("_metadata.file_path").alias(SOURCE_FILE)


def stamp(df: DataFrame, file_properties: bool = False) -> DataFrame:
    """All columns of a file scan, its source file and the time it was read.

    In a stream the time is one value per micro-batch, and the same value when a batch is replayed.
    With `file_properties` the size and modification time of the file come along, free of any
    lookup, because the scan already knows them.
    """
    properties = [
        F.col("_metadata.file_size").alias(SOURCE_SIZE),
        F.col("_metadata.file_modification_time").alias(SOURCE_TIME),
    ]
    return df.select(
        "*",
        source_file(),
        *(properties if file_properties else []),
        F.current_timestamp().alias(PROCESSING_TIME),
    )


def with_processed_date(
    df: DataFrame, time: str = PROCESSING_TIME, name: str = PROCESSED_DATE
) -> DataFrame:
    """Add the date text (`yyyy-MM-dd`) of a time column; the tables are partitioned by it."""
    return df.withColumn(name, F.date_format(time, "yyyy-MM-dd"))
