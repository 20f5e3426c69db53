"""Streaming scans of a landing folder: the rows of its CSV files, or the files themselves."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from tideline.functions.stamps import stamp, with_processed_date
from tideline.schemas import (
    BINARY_FILE,
    PROCESSED_DATE,
    PROCESSING_TIME,
    SOURCE_FILE,
    SOURCE_SIZE,
    SOURCE_TIME,
)

# The session settings that govern cleaning at the source.
CLEANUP_DELAY = "spark.sql.streaming.fileSource.log.cleanupDelay"
CLEANER_THREADS = "spark.sql.streaming.fileSource.cleaner.numThreads"

# How far behind the newest file seen a file may be. It bounds what the driver has to remember.
MAX_FILE_AGE = "7d"


def _stream_of(
    spark: SparkSession,
    schema: StructType,
    max_files_per_trigger: int,
    archive_dir: str | None,
    max_file_age: str,
) -> DataStreamReader:
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if max_files_per_trigger > 0:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader


def read_landing(
    spark: SparkSession,
    path: str,
    schema: StructType,
    header: bool = False,
    max_files_per_trigger: int = -1,
    archive_dir: str | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Stream every CSV file that lands under `path`, with a declared schema.

    Parsing is Spark's default: columns are positional, a bad cell or a missing trailing column is
    NULL, the row stays. Files are read without `multiLine`, so one huge file is still split over
    many tasks. `max_files_per_trigger` limits a micro-batch when it is above zero. `archive_dir`
    has Spark move the files of each finished micro-batch there once the next one commits; it is safe
    only where no other stream reads the folder, cleaning or not, as that one would miss them.

    Spark's driver remembers the names of files within `max_file_age` of the newest one seen, and
    skips older ones for ever, but for those of the first batch. `plans.jobs.load_late_files` loads
    what was skipped.
    """
    reader = _stream_of(spark, schema, max_files_per_trigger, archive_dir, max_file_age)
    return reader.option("header", header).csv(path)


def read_landing_files(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = -1,
    archive_dir: str | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Stream the files that land under `path`, one row each, stamped like their rows will be.

    The same files in the same batches as `read_landing`, but files without rows are there too,
    unless they have no byte at all: no scan of Spark's shows those. Content is not read.
    """
    reader = _stream_of(spark, BINARY_FILE, max_files_per_trigger, archive_dir, max_file_age)
    files = with_processed_date(stamp(reader.format("binaryFile").load(path), file_properties=True))
    return files.select(SOURCE_FILE, SOURCE_SIZE, SOURCE_TIME, PROCESSING_TIME, PROCESSED_DATE)


def literal_path(path: str) -> str:
    """A path that Spark's readers take as it stands, whatever pattern signs are in it."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in path)


def read_files(
    spark: SparkSession, paths: Sequence[str], schema: StructType, header: bool = False
) -> DataFrame:
    """The rows of named CSV files, parsed as `read_landing` does."""
    reader = spark.read.schema(schema).option("header", header)
    return reader.csv([literal_path(path) for path in paths])


@contextmanager
def source_cleaner(
    spark: SparkSession, cleanup_delay: str | None = None, threads: int | None = None
) -> Iterator[None]:
    """Session settings of the source cleaner, for the streams started inside the block.

    Spark reads both from the session and not from the stream's options. `threads=0` cleans within
    the commit of a batch; `cleanup_delay` is a Spark time text such as `3600s`.
    """
    wanted = {CLEANUP_DELAY: cleanup_delay, CLEANER_THREADS: threads}
    wanted = {name: str(value) for name, value in wanted.items() if value is not None}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
