"""Audit of landed files: how many rows, how large, read when, and one sample value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.schemas import (
    FIRST_VALUE,
    MODIFICATION_TIME,
    PROCESSED_DATE,
    PROCESSING_TIME,
    RECORD_COUNT,
    SIZE,
    SOURCE_FILE,
    SOURCE_SIZE,
    SOURCE_TIME,
)

FILE_KEYS = (SOURCE_FILE, PROCESSING_TIME, PROCESSED_DATE)
AUDIT_COLUMNS = (
    SOURCE_FILE,
    RECORD_COUNT,
    SIZE,
    MODIFICATION_TIME,
    PROCESSING_TIME,
    PROCESSED_DATE,
)


def record_counts(df: DataFrame, keys: Sequence[str] = FILE_KEYS) -> DataFrame:
    """Rows per file, time and date.

    Tasks count before the shuffle, so even a file that holds most rows sends one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(RECORD_COUNT))


def _newest_first(df: DataFrame, time: str) -> list[Column]:
    """Keys that sort the newest time first when they ascend, NULL last.

    Instants are taken as microseconds and local times as an interval, so that no clock change of
    the session's zone can reorder them.
    """
    kind, column = df.schema[time].dataType, F.col(time)
    if isinstance(kind, T.TimestampType):
        key = -F.unix_micros(column)
    elif isinstance(kind, T.TimestampNTZType):
        key = F.lit("1970-01-01").cast(kind) - column
    elif isinstance(kind, T.DateType):
        key = -F.unix_date(column)
    elif isinstance(kind, T.IntegralType):
        key = F.bitwise_not(column)
    else:
        key = -column
    return [column.isNull().alias("no_time"), key.alias("age")]


def latest_per_file(
    df: DataFrame,
    columns: Sequence[str],
    tie_break: Sequence[str] = (),
    file: str = SOURCE_FILE,
    time: str = PROCESSING_TIME,
) -> DataFrame:
    """The newest row of every file, cut to `columns`.

    All rows of a micro-batch carry the same time, so `tie_break` columns decide among them, lowest
    first. As an aggregate it keeps one row per file and task ahead of the shuffle, so a file with
    most of the rows does not pile up in one task, and a task sorts by file alone, which is quick
    where rows of a file lie together.
    """
    order = F.struct(*_newest_first(df, time), *tie_break)
    newest = df.groupBy(file).agg(F.min_by(F.struct(*columns), order).alias("row"))
    return newest.select("row.*")


def latest_per_file_by_window(
    df: DataFrame,
    columns: Sequence[str],
    tie_break: Sequence[str] = (),
    file: str = SOURCE_FILE,
    time: str = PROCESSING_TIME,
) -> DataFrame:
    """The same rows by rank, for times of any type that sorts.

    Spark limits the window to one row per file and task ahead of the shuffle, but each task first
    sorts all its rows by file, time and tie-break.
    """
    newest = Window.partitionBy(file).orderBy(F.desc(time), *(F.asc(c) for c in tie_break))
    needed = dict.fromkeys([file, time, *tie_break, *columns])
    return (
        df.select(*needed)
        .withColumn("row", F.row_number().over(newest))
        .filter(F.col("row") == 1)
        .select(*columns)
    )


def first_value(column: str, tie_break: Sequence[str] = ()) -> Column:
    """Aggregate form of the sample: `column` of the row that is lowest by `tie_break`.

    A NULL tie-break sorts lowest, and rows that share the lowest one are expected to agree; with no
    tie-break the smallest value is taken. One tie-break column of a fixed-width type over a
    fixed-width sample keeps the whole audit a hash aggregate; more columns are compared as a
    struct, which Spark aggregates by sorting.
    """
    if not tie_break:
        return F.min(column)
    if len(tie_break) > 1:
        return F.min_by(column, F.struct(*tie_break))
    (key,) = tie_break
    without_key = F.min(F.when(F.col(key).isNull(), F.col(column)))
    return F.when(F.count(key) < F.count(F.lit(1)), without_key).otherwise(F.min_by(column, key))


def audit_rows(
    df: DataFrame,
    first_column: str,
    tie_break: Sequence[str] = (),
    first_name: str = FIRST_VALUE,
) -> DataFrame:
    """One audit row per file from stamped rows that carry their file properties.

    A single aggregation: one shuffle of one partial row per file and task, with no window, no join
    and no cache of the batch.
    """
    return (
        df.groupBy(*FILE_KEYS)
        .agg(
            F.count(F.lit(1)).alias(RECORD_COUNT),
            F.max(SOURCE_SIZE).alias(SIZE),
            F.max(SOURCE_TIME).alias(MODIFICATION_TIME),
            first_value(first_column, tie_break).alias(first_name),
        )
        .select(*AUDIT_COLUMNS, first_name)
    )


def with_files_without_rows(audited: DataFrame, files: DataFrame) -> DataFrame:
    """Audit rows of all `files` of a batch: those without rows count 0 and have no sample.

    `files` has a row for each file with its properties, processing time and date. Both sides have
    one row per file.
    """
    (first_name,) = [name for name in audited.columns if name not in AUDIT_COLUMNS]
    found = audited.select(SOURCE_FILE, RECORD_COUNT, first_name)
    return (
        files.select(SOURCE_FILE, SIZE, MODIFICATION_TIME, PROCESSING_TIME, PROCESSED_DATE)
        .join(found, SOURCE_FILE, "left")
        .withColumn(RECORD_COUNT, F.coalesce(RECORD_COUNT, F.lit(0).cast("long")))
        .select(*AUDIT_COLUMNS, first_name)
    )


def audit_rows_by_join(
    df: DataFrame,
    first_column: str,
    tie_break: Sequence[str] = (),
    first_name: str = FIRST_VALUE,
) -> DataFrame:
    """The same audit rows as counts joined with a window sample.

    It reads `df` twice. `audit_rows` gives the same in one pass where the tie-break names one row
    of a file; among rows that share the lowest tie-break this form takes the smallest sample and
    that one any of theirs. It remains for those who compare the two, and for samples of several
    columns.
    """
    # Rows alike in the tie-break are ordered by the sample itself, NULL last.
    sampled = df.withColumn(FIRST_VALUE, F.col(first_column)).withColumn(
        "no_value", F.col(FIRST_VALUE).isNull()
    )
    order = [*tie_break, "no_value", FIRST_VALUE]
    samples = latest_per_file_by_window(sampled, [SOURCE_FILE, FIRST_VALUE], order)
    counts = df.groupBy(*FILE_KEYS).agg(
        F.count(F.lit(1)).alias(RECORD_COUNT),
        F.max(SOURCE_SIZE).alias(SIZE),
        F.max(SOURCE_TIME).alias(MODIFICATION_TIME),
    )
    return counts.join(samples, SOURCE_FILE, "inner").select(
        *AUDIT_COLUMNS, F.col(FIRST_VALUE).alias(first_name)
    )
