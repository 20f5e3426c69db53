"""The manifest of a table: one row for each file that a batch read, kept beside the table.

What is done on a date, and what has never been read, are questions about files. The manifest
answers them with one row per file, where the table has one per record. A batch writes its part
under the same partition as its rows, so a replay replaces both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.schemas import (
    BATCH_ID,
    FILES,
    MANIFEST,
    MODIFICATION_TIME,
    PROCESSED_DATE,
    SIZE,
    SOURCE_FILE,
    SOURCE_SIZE,
    SOURCE_TIME,
    STREAM_ID,
)
from tideline.sources.tables import (
    FOLDER_FORMATS,
    read_date,
    read_slice,
    read_table,
    table_exists,
    write_slice,
)

# The stream under which a table gets the manifest of rows that were written without one.
ADOPTED = "adopted"


def manifest_path(data_path: str) -> str:
    return f"{data_path.rstrip('/')}-files"


def manifest_rows(files: DataFrame) -> DataFrame:
    """Manifest rows from stamped file rows, one for each file.

    Spark's streams hand over files more than once where names hold pattern signs.
    """
    return files.groupBy(SOURCE_FILE).agg(
        F.max(SOURCE_SIZE).alias(SIZE), F.max(SOURCE_TIME).alias(MODIFICATION_TIME)
    )


def read_manifest(spark: SparkSession, data_path: str, fmt: str = "parquet") -> DataFrame:
    """Every file any batch of the table has read; empty for a table without a manifest."""
    path = manifest_path(data_path)
    if not table_exists(spark, path):
        return spark.createDataFrame([], MANIFEST)
    return read_table(spark, path, MANIFEST, fmt)


def files_read_on(
    spark: SparkSession, data_path: str, day: str, fmt: str = "parquet"
) -> DataFrame:
    """FILES of a date: source file and date, a row for each file and batch, from the manifest.

    A date that was written without a manifest is read row by row instead, one column of it;
    `adopt_date` gives it one. A table that is not there is an error.
    """
    path = manifest_path(data_path)
    if fmt in FOLDER_FORMATS and table_exists(spark, data_path):
        if table_exists(spark, f"{path}/{PROCESSED_DATE}={day}"):
            return read_slice(spark, path, FILES, fmt, **{PROCESSED_DATE: day})
    return read_date(spark, data_path, FILES, day, fmt)


def adopt_date(spark: SparkSession, data_path: str, day: str, fmt: str = "parquet") -> None:
    """Write the manifest of a date's rows that came without one: one row per file, no properties.

    The rows are read once, a column of them, and reduced in their tasks before the only shuffle.
    """
    path = manifest_path(data_path)
    own = {PROCESSED_DATE: day, STREAM_ID: ADOPTED, BATCH_ID: 0}
    files = read_date(spark, data_path, FILES, day, fmt).select(SOURCE_FILE).distinct()
    known = read_manifest(spark, data_path, fmt).filter(
        (F.col(PROCESSED_DATE) == day) & (F.col(STREAM_ID) != ADOPTED)
    )
    rows = files.join(known.select(SOURCE_FILE), SOURCE_FILE, "left_anti").select(
        SOURCE_FILE,
        F.lit(None).cast("long").alias(SIZE),
        F.lit(None).cast("timestamp").alias(MODIFICATION_TIME),
    )
    write_slice(rows, path, fmt, **own)
