"""Functions for `start_batches` that write a micro-batch exactly once.

A batch holds the rows of landed files, or just the files: then their rows are scanned once, while
they are written, and the batch's date comes from the few file rows.

Every batch owns the partition `processed_date=…/stream_id=…/batch_id=…` of each table it writes. A
replay has the same date and ids and overwrites that partition, so rows are neither lost nor
doubled. A batch that was written whole and lost only its commit is left as it is, because its
source files may have been archived since. The stream's id lives in its checkpoint: streams of
several landing folders, or one begun anew with a fresh checkpoint, add to the same tables without
touching each other's batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.stamps import stamp, with_processed_date
from tideline.functions.uri import plain_path
from tideline.operators.audit import audit_rows, audit_rows_by_join, with_files_without_rows
from tideline.schemas import (
    BATCH_ID,
    FIRST_VALUE,
    MANIFEST,
    OWNER,
    PROCESSED_DATE,
    PROCESSING_TIME,
    SOURCE_FILE,
    SOURCE_SIZE,
    SOURCE_TIME,
    STREAM_ID,
    loaded_schema,
)
from tideline.sources.landing import read_files
from tideline.sources.manifest import manifest_path, manifest_rows
from tideline.sources.tables import read_slice, slice_is_whole, write_slice

# Fixed value: the local property under which Spark names the running streaming query.
QUERY_ID = "sql.streaming.queryId"

BatchWriter = Callable[[DataFrame, int], None]
Transform = Callable[[DataFrame], DataFrame]


def loadable(landing: DataFrame, transform: Transform | None = None) -> DataFrame:
    """Landed rows with the stamps and file properties that the writers below expect.

    `transform` may derive further columns from the stamped rows. The date is put on last, always
    that of the processing time, because a micro-batch is stored under one date.
    """
    stamped = stamp(landing, file_properties=True)
    return with_processed_date(stamped if transform is None else stamped.transform(transform))


def auditable(
    landing: DataFrame,
    first_column: str,
    tie_break: Sequence[str] = (),
    transform: Transform | None = None,
) -> DataFrame:
    """Only what an audit needs of the landed rows.

    Spark plans a micro-batch before it hands it over, so columns must be left out here: inside the
    batch function it is too late to spare the CSV parser the others.
    """
    stamps = [SOURCE_FILE, SOURCE_SIZE, SOURCE_TIME, PROCESSING_TIME, PROCESSED_DATE]
    return loadable(landing, transform).select(*dict.fromkeys([*stamps, first_column, *tie_break]))


def _stream_id(batch: DataFrame) -> str:
    return batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)


def _own_partition(batch: DataFrame, batch_id: int) -> dict[str, object] | None:
    """The partition this micro-batch owns; None if it has no rows.

    The processing time is one for the whole batch, so its first row tells the date.
    """
    row = batch.select(PROCESSED_DATE).first()
    if row is None:
        return None
    return {PROCESSED_DATE: row[0], STREAM_ID: _stream_id(batch), BATCH_ID: batch_id}


def _stored_schema(batch: DataFrame) -> T.StructType:
    """The batch's columns as read back from its partition."""
    columns = batch.drop(PROCESSED_DATE).schema.fields
    date = T.StructField(PROCESSED_DATE, T.StringType())
    return T.StructType([*columns, date, *OWNER.fields])


def _unless_whole(write: BatchWriter, last_path: str, fmt: str) -> BatchWriter:
    """`write`, but not for a replayed batch whose part of the table written last is already whole.

    Only the first batch after a restart, or one out of turn, can be a replay and is looked up. It
    must not be read again: once it is whole its files may be archived, and Spark would pass over
    missing files and hand over a smaller batch.
    """
    next_id: dict[str, int] = {}

    def write_unless_whole(batch: DataFrame, batch_id: int) -> None:
        stream_id = _stream_id(batch)
        own = {PROCESSED_DATE: "*", STREAM_ID: stream_id, BATCH_ID: batch_id}
        in_turn = next_id.get(stream_id) == batch_id
        if in_turn or not slice_is_whole(batch.sparkSession, last_path, fmt, **own):
            write(batch, batch_id)
        next_id[stream_id] = batch_id + 1

    return write_unless_whole


def audit_writer(
    metadata_path: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    by_join: bool = False,
    first_name: str = FIRST_VALUE,
    partition_by: str | None = None,
) -> BatchWriter:
    """Write one METADATA row per file of the batch.

    `by_join` takes the form with a window and a join; the batch is then read twice and is kept
    for the while.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = _own_partition(batch, batch_id)
        if own is None:
            return
        if not by_join:
            rows = audit_rows(batch, first_column, tie_break, first_name)
            write_slice(rows, metadata_path, fmt, partition_by, **own)
            return
        batch.persist()
        try:
            rows = audit_rows_by_join(batch, first_column, tie_break, first_name)
            write_slice(rows, metadata_path, fmt, partition_by, **own)
        finally:
            batch.unpersist()

    return _unless_whole(write, metadata_path, fmt)


def load_writer(
    data_path: str, fmt: str = "parquet", partition_by: str | None = None
) -> BatchWriter:
    """Write the batch to DATA."""

    def write(batch: DataFrame, batch_id: int) -> None:
        own = _own_partition(batch, batch_id)
        if own is not None:
            write_slice(batch, data_path, fmt, partition_by, **own)

    return _unless_whole(write, data_path, fmt)


def load_files(
    files: DataFrame,
    own: dict[str, object],
    processing_time: int,
    schema: T.StructType,
    data_path: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    transform: Transform | None = None,
    header: bool = False,
) -> DataFrame:
    """Write files to the manifest and their rows to DATA, as one batch; return the manifest rows.

    `files` has stamped file rows, `processing_time` microseconds since 1970. The names of the
    batch's files pass through the driver, as they do inside any file scan; limit the files of a
    batch where that matters. The manifest is written first and DATA after it, so what is in a
    table that is written after both is whole in DATA.
    """
    spark = files.sparkSession
    path = manifest_path(data_path)
    write_slice(manifest_rows(files), path, fmt, **own)
    listed = read_slice(spark, path, MANIFEST, fmt, **own)
    paths = [row[0] for row in listed.select(plain_path(SOURCE_FILE)).toLocalIterator()]
    rows = stamp(read_files(spark, paths, schema, header), file_properties=True)
    rows = rows.withColumn(PROCESSING_TIME, F.timestamp_micros(F.lit(processing_time)))
    rows = with_processed_date(rows if transform is None else rows.transform(transform))
    write_slice(rows, data_path, fmt, partition_by, **own)
    return listed


def audit_files(
    listed: DataFrame,
    own: dict[str, object],
    loaded: DataFrame,
    processing_time: int,
    metadata_path: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    first_name: str = FIRST_VALUE,
    partition_by: str | None = None,
    empty_files: bool = True,
) -> None:
    """Write the METADATA rows of a batch of loaded files; a file without rows counts 0."""
    rows = audit_rows(loaded, first_column, tie_break, first_name)
    if empty_files:
        time = F.timestamp_micros(F.lit(processing_time))
        rows = with_files_without_rows(rows, listed.withColumn(PROCESSING_TIME, time))
    write_slice(rows, metadata_path, fmt, partition_by, **own)


def _batch_of_files(batch: DataFrame, batch_id: int) -> tuple[dict[str, object], int] | None:
    """The partition and the processing time of a batch of files; None if there are none."""
    row = batch.select(PROCESSED_DATE, F.unix_micros(PROCESSING_TIME)).first()
    if row is None:
        return None
    own = {PROCESSED_DATE: row[0], STREAM_ID: _stream_id(batch), BATCH_ID: batch_id}
    return own, row[1]


def load_files_writer(
    schema: T.StructType, data_path: str, fmt: str = "parquet", **loading: object
) -> BatchWriter:
    """Load the files of the batch into DATA and its manifest; options as for `load_files`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        found = _batch_of_files(batch, batch_id)
        if found is not None:
            load_files(batch, *found, schema, data_path, fmt, **loading)

    return _unless_whole(write, data_path, fmt)


def load_and_audit_files(
    files: DataFrame,
    own: dict[str, object],
    processing_time: int,
    schema: T.StructType,
    data_path: str,
    metadata_path: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    first_name: str = FIRST_VALUE,
    partition_by: str | None = None,
    metadata_partition_by: str | None = None,
    transform: Transform | None = None,
    header: bool = False,
    empty_files: bool = True,
) -> None:
    """Load files as one batch, then write their audit rows from the columns needed of DATA."""
    spark = files.sparkSession
    listed = load_files(
        files, own, processing_time, schema, data_path, fmt, partition_by, transform, header
    )
    stored = _loaded_columns(spark, schema, transform, first_column, tie_break)
    loaded = read_slice(spark, data_path, stored, fmt, **own)
    audit_files(
        listed, own, loaded, processing_time, metadata_path, first_column, tie_break, fmt,
        first_name, metadata_partition_by, empty_files,
    )


def _loaded_columns(
    spark: SparkSession,
    schema: T.StructType,
    transform: Transform | None,
    first_column: str,
    tie_break: Sequence[str],
) -> T.StructType:
    """What the audit reads back of DATA, in the types the transform gave it."""
    rows = spark.createDataFrame([], loaded_schema(schema)).drop(*OWNER.names)
    if transform is not None:
        rows = rows.transform(transform)
    wanted = dict.fromkeys(
        [SOURCE_FILE, SOURCE_SIZE, SOURCE_TIME, PROCESSING_TIME, PROCESSED_DATE, first_column, *tie_break]
    )
    return T.StructType([rows.schema[name] for name in wanted])


def load_and_audit_files_writer(
    schema: T.StructType,
    data_path: str,
    metadata_path: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    **options: object,
) -> BatchWriter:
    """Load the files of the batch, then audit them; options as for `load_and_audit_files`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        found = _batch_of_files(batch, batch_id)
        if found is not None:
            load_and_audit_files(
                batch, *found, schema, data_path, metadata_path, first_column, tie_break, fmt,
                **options,
            )

    return _unless_whole(write, metadata_path, fmt)


def load_and_audit_writer(
    data_path: str,
    metadata_path: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    first_name: str = FIRST_VALUE,
    partition_by: str | None = None,
    metadata_partition_by: str | None = None,
) -> BatchWriter:
    """Write the batch to DATA, then its audit rows to METADATA.

    The CSV text is parsed once: the audit reads the columns it needs back from the partition just
    written. Both tables get one date for a file, and a file in METADATA is whole in DATA.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = _own_partition(batch, batch_id)
        if own is None:
            return
        write_slice(batch, data_path, fmt, partition_by, **own)
        loaded = read_slice(batch.sparkSession, data_path, _stored_schema(batch), fmt, **own)
        rows = audit_rows(loaded, first_column, tie_break, first_name)
        write_slice(rows, metadata_path, fmt, metadata_partition_by, **own)

    return _unless_whole(write, metadata_path, fmt)
