"""The jobs a user runs: load, audit, both at once, and archive.

A stream's progress is kept below `checkpoint_root` under its job and landing folder. `name` only
names the running query; streams that run side by side in one session need different ones.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tideline.functions.stamps import stamp, with_processed_date
from tideline.operators import archive, order
from tideline.operators.mover import run_moves
from tideline.schemas import (
    BATCH_ID,
    FILES,
    FIRST_VALUE,
    MANIFEST,
    MODIFICATION_TIME,
    PROCESSED_DATE,
    REPORT,
    RUN,
    SIZE,
    SOURCE_FILE,
    SOURCE_SIZE,
    SOURCE_TIME,
    STORED_REPORT,
    STREAM_ID,
)
from tideline.scratch import delete_at_exit, new_folder
from tideline.sources.inventory import list_files
from tideline.sources.landing import MAX_FILE_AGE, read_landing, read_landing_files
from tideline.sources.manifest import files_read_on, manifest_path, read_manifest
from tideline.sources.tables import (
    FOLDER_FORMATS,
    iso_date,
    read_date,
    prepare_table,
    read_slice,
    read_table,
    slice_is_whole,
    table_exists,
    write_slice,
)
from tideline.streaming.sinks import (
    EVERY_TEN_SECONDS,
    checkpoint_for,
    start_batches,
    start_table,
)
from tideline.streaming.writers import (
    Transform,
    audit_writer,
    auditable,
    load_and_audit_files,
    load_and_audit_files_writer,
    load_files_writer,
)


def start_load(
    spark: SparkSession,
    landing_path: str,
    schema: StructType,
    data_path: str,
    checkpoint_root: str,
    partition_by: str | None = None,
    fmt: str = "parquet",
    trigger: dict[str, object] = EVERY_TEN_SECONDS,
    transform: Transform | None = None,
    name: str = "load",
    sole_reader: bool = False,
    **landing_options: object,
) -> StreamingQuery:
    """Stream landed files into DATA. `transform` may derive further columns of the stamped rows.

    Folder formats are written batch by batch as the joint job writes them, so either job may go on
    with the other's table: a micro-batch names its files, which go to the manifest, and their rows
    are scanned once. `partition_by` parts the rows of a batch further, by one of their columns; all
    jobs on a table must name the same. Formats that keep a log of their own are written by Spark's
    sink for them, from a stream of rows.

    `archive_dir` takes files away from every other stream that reads the folder, such as an audit
    in a job of its own; it needs `sole_reader=True`, which says that there is none.
    """
    if landing_options.get("archive_dir") is not None and not sole_reader:
        raise ValueError("archive_dir takes files from other streams; say sole_reader=True")
    checkpoint = checkpoint_for(checkpoint_root, "load", landing_path)
    if fmt in FOLDER_FORMATS:
        prepare_table(spark, data_path, fmt)
        prepare_table(spark, manifest_path(data_path), fmt)
        header = landing_options.pop("header", False)
        files = read_landing_files(spark, landing_path, **landing_options)
        writer = load_files_writer(
            schema, data_path, fmt, partition_by=partition_by, transform=transform, header=header
        )
        return start_batches(files, writer, checkpoint, name, trigger)
    rows = stamp(read_landing(spark, landing_path, schema, **landing_options))
    rows = with_processed_date(rows if transform is None else rows.transform(transform))
    return start_table(
        rows, data_path, checkpoint, name, partition_by or PROCESSED_DATE, fmt, trigger
    )


def start_audit(
    spark: SparkSession,
    landing_path: str,
    schema: StructType,
    metadata_path: str,
    checkpoint_root: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    trigger: dict[str, object] = EVERY_TEN_SECONDS,
    by_join: bool = False,
    first_name: str = FIRST_VALUE,
    transform: Transform | None = None,
    name: str = "audit",
    partition_by: str | None = None,
    **landing_options: object,
) -> StreamingQuery:
    """Stream landed files into METADATA alone; the sample goes to the column `first_name`.

    `partition_by` parts METADATA further by one of its columns. There is no `archive_dir` here:
    an audit job has a load job beside it, which would miss the files taken away.
    """
    if landing_options.get("archive_dir") is not None:
        raise ValueError("archive_dir would take files from the load; use the joint job")
    prepare_table(spark, metadata_path, fmt)
    landing = read_landing(spark, landing_path, schema, **landing_options)
    return start_batches(
        auditable(landing, first_column, tie_break, transform),
        audit_writer(
            metadata_path, first_column, tie_break, fmt, by_join, first_name, partition_by
        ),
        checkpoint_for(checkpoint_root, "audit", landing_path),
        name,
        trigger,
    )


def start_load_and_audit(
    spark: SparkSession,
    landing_path: str,
    schema: StructType,
    data_path: str,
    metadata_path: str,
    checkpoint_root: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    trigger: dict[str, object] = EVERY_TEN_SECONDS,
    first_name: str = FIRST_VALUE,
    transform: Transform | None = None,
    name: str = "load_and_audit",
    partition_by: str | None = None,
    metadata_partition_by: str | None = None,
    header: bool = False,
    empty_files: bool = True,
    **landing_options: object,
) -> StreamingQuery:
    """Stream landed files into DATA and METADATA from the same micro-batches.

    The two `partition_by` part either table further, by one of its columns. Files may be archived
    at the source here (`archive_dir`), if no other stream reads the folder. Files without rows are
    in METADATA with a count of 0, unless `empty_files` is turned off.
    """
    prepare_table(spark, data_path, fmt)
    prepare_table(spark, manifest_path(data_path), fmt)
    prepare_table(spark, metadata_path, fmt)
    return start_batches(
        read_landing_files(spark, landing_path, **landing_options),
        load_and_audit_files_writer(
            schema, data_path, metadata_path, first_column, tie_break, fmt, first_name=first_name,
            partition_by=partition_by, metadata_partition_by=metadata_partition_by,
            transform=transform, header=header, empty_files=empty_files,
        ),
        checkpoint_for(checkpoint_root, "load_and_audit", landing_path),
        name,
        trigger,
    )


def archive_committed(
    spark: SparkSession,
    landing_path: str,
    metadata_path: str,
    archive_dir: str,
    lists_path: str,
    status_path: str,
    fmt: str = "parquet",
    run: int = 0,
    tasks: int | None = None,
) -> DataFrame:
    """Move every landed file that METADATA says is committed to `archive_dir`; the moves' status.

    Cleaning at the source lags a batch, so the files of a stream's last batch stay; this takes them
    after the stream has ended, or beside it: a file in METADATA is not read again. The files go
    where cleaning at the source puts them. Each sweep of a landing folder is a `run` of its own.
    """
    committed = read_table(spark, metadata_path, FILES, fmt).select(SOURCE_FILE)
    done = list_files(spark, landing_path).join(committed, SOURCE_FILE, "left_semi")
    return run_moves(done, archive_dir, lists_path, status_path, tasks, run)


def _stream_of_checkpoint(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint for life."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def load_late_files(
    spark: SparkSession,
    landing_path: str,
    schema: StructType,
    data_path: str,
    metadata_path: str,
    checkpoint_root: str,
    first_column: str,
    tie_break: Sequence[str] = (),
    fmt: str = "parquet",
    max_file_age: str = MAX_FILE_AGE,
    files_per_batch: int = 10_000,
    **options: object,
) -> int:
    """Load and audit the files that the joint job's stream has skipped as too old; their number.

    The stream skips a file modified more than `max_file_age` before the newest one it has seen, and
    what it has skipped it never reads. Those are the files of a listing that are as old as that
    by the newest the stream has *committed*, less an anti-join with the manifest: whatever the
    stream is at meanwhile, it cannot be one of them. They are loaded oldest first, in batches of
    the stream `late-…`, each of which is listed in the manifest before it is read, so a run that
    was broken off is taken up again and no file is loaded twice. It runs beside the stream or
    without it; two runs side by side are not allowed. `options` are those of the joint job.
    """
    stream = _stream_of_checkpoint(
        spark, checkpoint_for(checkpoint_root, "load_and_audit", landing_path)
    )
    own_stream = f"late-{stream}"
    loaded = 0
    while True:
        manifest = read_manifest(spark, data_path, fmt)
        batch = _begun_late_batch(manifest, own_stream, metadata_path, fmt)
        if batch is None:
            last = manifest.filter(F.col(STREAM_ID) == own_stream).agg(F.max(BATCH_ID)).first()[0]
            # METADATA is written last, so the batches that tell how far the stream is are whole.
            committed = read_table(spark, metadata_path, MANIFEST, fmt)
            newest = F.max(F.when(F.col(STREAM_ID) == stream, F.col(MODIFICATION_TIME)))
            reach = committed.agg((newest - _interval(max_file_age)).alias("reach"))
            late = (
                list_files(spark, landing_path)
                .join(reach, F.col(MODIFICATION_TIME) < F.col("reach"))
                .join(manifest.select(SOURCE_FILE), SOURCE_FILE, "left_anti")
                .orderBy(MODIFICATION_TIME, SOURCE_FILE)
                .limit(files_per_batch)
            )
            number = 0 if last is None else last + 1
        else:
            number, day = batch
            own = {PROCESSED_DATE: day, STREAM_ID: own_stream, BATCH_ID: number}
            late = read_slice(spark, manifest_path(data_path), MANIFEST, fmt, **own)
        late = late.select(
            SOURCE_FILE, F.col(SIZE).alias(SOURCE_SIZE), F.col(MODIFICATION_TIME).alias(SOURCE_TIME)
        )
        # The rows that are to be stored must not be a listing of the folder, nor the slice itself.
        staging = new_folder(spark, "late-files")
        late.write.parquet(staging)
        delete_at_exit(spark, staging)
        files = spark.read.schema(late.schema).parquet(staging)
        n, now = files.agg(F.count(F.lit(1)), F.unix_micros(F.current_timestamp())).first()
        if n == 0:
            return loaded
        if batch is None:
            day = spark.range(1).select(
                F.date_format(F.timestamp_micros(F.lit(now)), "yyyy-MM-dd")
            ).first()[0]
        own = {PROCESSED_DATE: day, STREAM_ID: own_stream, BATCH_ID: number}
        load_and_audit_files(
            files, own, now, schema, data_path, metadata_path, first_column, tie_break, fmt, **options
        )
        loaded += n


def _begun_late_batch(
    manifest: DataFrame, stream: str, metadata_path: str, fmt: str
) -> tuple[int, str] | None:
    """Number and date of the newest late batch, if its audit was not finished."""
    own = manifest.filter(F.col(STREAM_ID) == stream)
    last = own.agg(F.max(F.struct(BATCH_ID, PROCESSED_DATE)).alias("last")).first()["last"]
    if last is None:
        return None
    number, day = last[BATCH_ID], last[PROCESSED_DATE]
    keys = {PROCESSED_DATE: day, STREAM_ID: stream, BATCH_ID: number}
    if slice_is_whole(manifest.sparkSession, metadata_path, fmt, **keys):
        return None
    return number, day


# The time units of a file age, as Spark's file source spells them.
AGE_UNITS = {"s": 1, "m": 60, "min": 60, "h": 3600, "d": 86_400}


def _interval(age: str) -> Column:
    """A file age such as `7d` as an interval."""
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", age)
    if found is None or found[2] not in AGE_UNITS:
        raise ValueError(f"not a file age such as 7d, 12h, 30min or 90s: {age!r}")
    seconds = int(found[1]) * AGE_UNITS[found[2]]
    return F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def archive_date(
    spark: SparkSession,
    data_path: str,
    metadata_path: str,
    report_path: str,
    move_list_path: str,
    date: str,
    prefix: str,
    limit: int = -1,
    fmt: str = "parquet",
    run: int = 0,
) -> DataFrame:
    """Report the files of `date` that are done, list them for the mover, and return the report.

    With a `limit`, the runs 0, 1, 2, ... of a date work its files off: each takes the next slice of
    one order of the date's files, which is sorted and stored by the first of them beside the
    report. Files that are done later get their places after the end. Each run keeps its own part of
    the report and leaves out what the other runs have. Running one again replaces its part and the
    list: it begins where it began. The report is stored first and the move list is made from what was stored,
    so the two agree even while the tables grow. A date never written is empty; a table that is
    not there is an error, raised before anything is replaced.
    """
    date = iso_date(date)
    data = files_read_on(spark, data_path, date, fmt)
    metadata = read_date(spark, metadata_path, FILES, date, fmt)
    files = archive.candidates(data, metadata, date)
    if table_exists(spark, report_path):
        stored = read_slice(spark, report_path, STORED_REPORT, fmt, processed_date=date)
        files = archive.not_in(files, stored.filter(F.col(RUN) != run))
    places = order.order_path(report_path)
    if limit >= 0 or order.has_order(spark, places, date):
        known = order.ordered_files(spark, places, date, fmt)
        order.extend_order(archive.not_in(files, known), places, date, fmt)
        files = order.slice_of_run(spark, places, date, run, limit, fmt)
    own = {PROCESSED_DATE: date, RUN: run}
    write_slice(archive.report_rows(files, date), report_path, fmt, **own)
    report = read_slice(spark, report_path, REPORT, fmt, **own)
    archive.write_move_list(archive.move_list(report, prefix), move_list_path)
    return report
