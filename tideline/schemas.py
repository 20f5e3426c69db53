"""Column names and schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the stored tables.
SOURCE_FILE = "source_file"
PROCESSING_TIME = "processing_time"
PROCESSED_DATE = "processed_date"
RECORD_COUNT = "record_count"
FILE_PATH = "file_path"
SIZE = "size"
MODIFICATION_TIME = "modification_time"
FIRST_VALUE = "first_value"
# File properties on each row, named so as not to meet a landed column.
SOURCE_SIZE = "source_file_size"
SOURCE_TIME = "source_file_modification_time"
STREAM_ID = "stream_id"
BATCH_ID = "batch_id"
RUN = "run"

# The partition columns that name the micro-batch which wrote a row.
OWNER = T.StructType(
    [
        T.StructField(STREAM_ID, T.StringType()),
        T.StructField(BATCH_ID, T.LongType()),
    ]
)

# The loan records of the default landing folder, in file order.
LOANS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("first_time_buyer", T.BooleanType()),
        T.StructField("ltv", T.FloatType()),
        T.StructField("loan_amount", T.FloatType()),
        T.StructField("loan_term", T.IntegerType()),
        T.StructField("interest_rate", T.FloatType()),
        T.StructField("loan_purpose", T.StringType()),
        T.StructField("loan_type", T.StringType()),
        T.StructField("loan_id", T.IntegerType()),
    ]
)

# What the archive needs of DATA and METADATA.
FILES = T.StructType(
    [
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(PROCESSED_DATE, T.StringType()),
    ]
)

# The files a batch has read, one row each, beside DATA.
MANIFEST = T.StructType(
    [
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(SIZE, T.LongType()),
        T.StructField(MODIFICATION_TIME, T.TimestampType()),
        T.StructField(PROCESSED_DATE, T.StringType()),
        *OWNER.fields,
    ]
)

REPORT = T.StructType(
    [
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(PROCESSED_DATE, T.DateType()),
    ]
)

# The columns of a binary-file scan.
BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

# The report as stored: every run of the archive job on a date keeps its own files.
STORED_REPORT = T.StructType([*REPORT.fields, T.StructField(RUN, T.LongType())])

# Field names and the two outcomes of a move.
MOVE_STATUS = T.StructType(
    [
        T.StructField(FILE_PATH, T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("moved_datetime", T.TimestampType()),
        T.StructField("exception", T.StringType()),
    ]
)
MOVED = "success"
NOT_MOVED = "failed"


def data_schema(landing: T.StructType) -> T.StructType:
    """DATA: the landed columns, then where and when each row was read."""
    return T.StructType(
        [
            *landing.fields,
            T.StructField(SOURCE_FILE, T.StringType()),
            T.StructField(PROCESSING_TIME, T.TimestampType()),
            T.StructField(PROCESSED_DATE, T.StringType()),
        ]
    )


def loaded_schema(landing: T.StructType) -> T.StructType:
    """DATA as the joint load-and-audit job stores it.

    The file properties are constant within a file, so Parquet keeps them as a few bytes per row
    group; they spare the audit a second pass over the CSV text.
    """
    return T.StructType(
        [
            *landing.fields,
            T.StructField(SOURCE_FILE, T.StringType()),
            T.StructField(SOURCE_SIZE, T.LongType()),
            T.StructField(SOURCE_TIME, T.TimestampType()),
            T.StructField(PROCESSING_TIME, T.TimestampType()),
            T.StructField(PROCESSED_DATE, T.StringType()),
            *OWNER.fields,
        ]
    )


def metadata_schema(first_value: T.DataType, first_name: str = FIRST_VALUE) -> T.StructType:
    """METADATA: one audit row per file and batch; the sample has the sampled column's type."""
    return T.StructType(
        [
            T.StructField(SOURCE_FILE, T.StringType()),
            T.StructField(RECORD_COUNT, T.LongType()),
            T.StructField(SIZE, T.LongType()),
            T.StructField(MODIFICATION_TIME, T.TimestampType()),
            T.StructField(PROCESSING_TIME, T.TimestampType()),
            T.StructField(PROCESSED_DATE, T.StringType()),
            T.StructField(first_name, first_value),
            *OWNER.fields,
        ]
    )
