"""Queries over the audit of landed files."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.stamps import with_processed_date
from tideline.operators.audit import latest_per_file, record_counts
from tideline.plans.jobs import start_audit, start_load_and_audit
from tideline.schemas import (
    BATCH_ID,
    FIRST_VALUE,
    PROCESSING_TIME,
    RECORD_COUNT,
    SIZE,
    SOURCE_FILE,
    loaded_schema,
    metadata_schema,
)
from tideline.scratch import new_folder
from tideline.sources.inventory import list_files, with_properties
from tideline.sources.landing import read_landing
from tideline.sources.tables import read_table
from tideline.streaming.sinks import UNTIL_DONE, start_batches
from tideline.streaming.writers import load_and_audit_writer, loadable
from workload.ingest import quarter_of
from workload.landing import LANDING_KEY, landed_orders, landing_key, order_files, table

SAMPLE, TIE_BREAK = "o_custkey", ("o_orderkey",)


def metadata(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    sample = table(spark, sf_dir, "orders").schema[SAMPLE].dataType
    return read_table(spark, f"{folder}/metadata", metadata_schema(sample))


def summary(rows: DataFrame) -> DataFrame:
    return rows.select(landing_key(), RECORD_COUNT, FIRST_VALUE)


def file_metadata_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "load-and-audit")
    query = start_load_and_audit(
        spark,
        landed_orders(spark, sf_dir),
        table(spark, sf_dir, "orders").schema,
        f"{folder}/data",
        f"{folder}/metadata",
        f"{folder}/checkpoint",
        SAMPLE,
        TIE_BREAK,
        trigger=UNTIL_DONE,
        name=f"load-and-audit-{folder[-8:]}",
        header=True,
    )
    query.awaitTermination()
    return summary(metadata(spark, sf_dir, folder))


def audit(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    """METADATA of the landed orders from a stream that keeps no data."""
    folder = new_folder(spark, "audit")
    query = start_audit(
        spark,
        landed_orders(spark, sf_dir),
        table(spark, sf_dir, "orders").schema,
        f"{folder}/metadata",
        f"{folder}/checkpoint",
        SAMPLE,
        TIE_BREAK,
        trigger=UNTIL_DONE,
        name=f"audit-{folder[-8:]}",
        header=True,
        **options,
    )
    query.awaitTermination()
    return metadata(spark, sf_dir, folder)


def audit_join_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(audit(spark, sf_dir, by_join=True))


def replay_idempotent_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch fails after both of its writes and runs again when the stream is restarted."""
    landing = landed_orders(spark, sf_dir)
    schema = table(spark, sf_dir, "orders").schema
    folder = new_folder(spark, "replay")
    data_path, metadata_path = f"{folder}/data", f"{folder}/metadata"
    write = load_and_audit_writer(data_path, metadata_path, SAMPLE, TIE_BREAK)
    per_trigger = quarter_of(order_files(spark, sf_dir))
    failed: list[int] = []

    def write_then_fail(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("failure between the writes and the commit")

    def run() -> None:
        stream = read_landing(
            spark, landing, schema, header=True, max_files_per_trigger=per_trigger
        )
        start_batches(
            loadable(stream),
            write_then_fail,
            f"{folder}/checkpoint",
            f"replay-{folder[-8:]}",
            UNTIL_DONE,
        ).awaitTermination()

    try:
        run()
    except StreamingQueryException:
        run()
    data = read_table(spark, data_path, loaded_schema(schema))
    loaded = record_counts(data, [SOURCE_FILE, BATCH_ID]).withColumnRenamed(RECORD_COUNT, "loaded")
    return (
        metadata(spark, sf_dir, folder)
        .join(loaded, [SOURCE_FILE, BATCH_ID])
        .select(landing_key(), RECORD_COUNT, FIRST_VALUE, "loaded")
    )


def record_count_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias(SOURCE_FILE),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias(PROCESSING_TIME),
    )
    return record_counts(with_processed_date(events)).withColumnRenamed(SOURCE_FILE, "event_type")


def latest_row_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return latest_per_file(
        events, ["user_id", "event_id", "ts"], ["event_id"], file="user_id", time="ts"
    )


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audited files and one that is gone, with the sizes a listing of the folder gives them."""
    audited = audit(spark, sf_dir).select(SOURCE_FILE, F.col(SIZE).alias("audited_size"))
    gone = audited.select(
        F.regexp_replace(SOURCE_FILE, rf"{LANDING_KEY}=\d+", f"{LANDING_KEY}=0").alias(SOURCE_FILE),
        F.lit(None).cast("long").alias("audited_size"),
    )
    gone = gone.orderBy(SOURCE_FILE).limit(1)
    files = audited.unionByName(gone)
    listing = list_files(spark, landed_orders(spark, sf_dir))
    return with_properties(files, listing).select(
        landing_key(),
        F.col(SIZE).isNotNull().alias("has_size"),
        F.coalesce(F.col(SIZE) == F.col("audited_size"), F.lit(False)).alias("size_agrees"),
    )


QUERIES = {
    "file_metadata_audit": file_metadata_audit,
    "audit_join_form": audit_join_form,
    "replay_idempotent_audit": replay_idempotent_audit,
    "record_count_per_file": record_count_per_file,
    "latest_row_per_file": latest_row_per_file,
    "file_inventory": file_inventory,
}
