"""Queries over the streaming scan, the stamps and the table sink."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.stamps import stamp, with_processed_date
from tideline.functions.uri import blob_url, container_prefix, strip_prefix
from tideline.plans.jobs import archive_committed, start_load, start_load_and_audit
from tideline.schemas import (
    MOVED,
    PROCESSED_DATE,
    PROCESSING_TIME,
    RECORD_COUNT,
    SOURCE_FILE,
    data_schema,
    metadata_schema,
)
from tideline.scratch import new_folder
from tideline.sources.inventory import list_files
from tideline.sources.landing import read_landing, source_cleaner
from tideline.sources.tables import read_table
from tideline.streaming.sinks import UNTIL_DONE, checkpoint_for, start_batches, start_table
from tideline.streaming.writers import load_writer
from workload.landing import (
    landed_customers,
    landed_orders,
    landing_key,
    order_files,
    own_landed_orders,
    table,
)

ONE_DATE = "2024-01-15"

CUSTOMER_ROWS = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
    ]
)


def load(
    spark: SparkSession, landing: str, schema: T.StructType, **landing_options: object
) -> DataFrame:
    """Load a landing folder to its end and scan the DATA table it gave."""
    folder = new_folder(spark, "load")
    query = start_load(
        spark,
        landing,
        schema,
        f"{folder}/data",
        f"{folder}/checkpoint",
        trigger=UNTIL_DONE,
        name=f"load-{folder[-8:]}",
        header=True,
        **landing_options,
    )
    query.awaitTermination()
    return read_table(spark, f"{folder}/data", data_schema(schema))


def quarter_of(files: int) -> int:
    """Files per micro-batch that take a landing folder in at most four batches."""
    return max(1, math.ceil(files / 4))


def csv_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream of rows into Spark's own partitioned sink, read back by its log."""
    orders = table(spark, sf_dir, "orders")
    folder = new_folder(spark, "ingest")
    landing = landed_orders(spark, sf_dir)
    query = start_table(
        with_processed_date(stamp(read_landing(spark, landing, orders.schema, header=True))),
        f"{folder}/data",
        checkpoint_for(f"{folder}/checkpoint", "ingest", landing),
        f"ingest-{folder[-8:]}",
        trigger=UNTIL_DONE,
    )
    query.awaitTermination()
    data = read_table(spark, f"{folder}/data", data_schema(orders.schema))
    return data.select(*orders.columns, landing_key())


def csv_permissive_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = load(spark, landed_customers(spark, sf_dir), CUSTOMER_ROWS)
    return data.select(*CUSTOMER_ROWS.names)


def ingest_rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = load(
        spark,
        landed_orders(spark, sf_dir),
        table(spark, sf_dir, "orders").schema,
        max_files_per_trigger=quarter_of(order_files(spark, sf_dir)),
    )
    per_file = data.groupBy(SOURCE_FILE, PROCESSING_TIME).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.count_distinct(PROCESSING_TIME).alias("n_batches"),
        F.count_distinct(SOURCE_FILE).alias("n_files"),
        F.sum("n").alias("n_rows"),
    )


def stamp_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = load(spark, landed_orders(spark, sf_dir), table(spark, sf_dir, "orders").schema)
    date_of_time = F.date_format(PROCESSING_TIME, "yyyy-MM-dd")
    per_file = data.groupBy(SOURCE_FILE, PROCESSING_TIME).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(PROCESSED_DATE) != date_of_time).alias("n_date_mismatch"),
    )
    return per_file.groupBy(landing_key()).agg(
        F.sum("n_rows").alias("n_rows"),
        F.count_distinct(PROCESSING_TIME).alias("n_times"),
        F.sum("n_date_mismatch").alias("n_date_mismatch"),
    )


def processed_date_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return events.transform(with_processed_date, time="ts").select("event_id", PROCESSED_DATE)


def partitioned_sink_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    folder = new_folder(spark, "events")
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    event_date = F.date_format("ts", "yyyy-MM-dd").alias("event_date")
    query = start_batches(
        with_processed_date(stamp(stream).select("*", event_date)),
        load_writer(f"{folder}/data", partition_by="event_date"),
        checkpoint_for(f"{folder}/checkpoint", "events", sf_dir),
        f"events-{folder[-8:]}",
        trigger=UNTIL_DONE,
    )
    query.awaitTermination()
    stored = T.StructType([*schema.fields, T.StructField("event_date", T.StringType())])
    data = read_table(spark, f"{folder}/data", stored)
    return data.filter(F.col("event_date") == ONE_DATE).select(
        "event_id", "user_id", "event_type", F.col("event_date").alias(PROCESSED_DATE)
    )


def clean_source_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load and audit in one job that archives at the source, then sweep up its last batch's files.

    The result tells what was read and what lies where.
    """
    landing = own_landed_orders(spark, sf_dir)
    folder = new_folder(spark, "archived")
    orders = table(spark, sf_dir, "orders").schema
    with source_cleaner(spark, cleanup_delay="3600s", threads=0):
        start_load_and_audit(
            spark,
            landing,
            orders,
            f"{folder}/data",
            f"{folder}/metadata",
            f"{folder}/checkpoint",
            "o_orderkey",
            trigger=UNTIL_DONE,
            name=f"clean-{folder[-8:]}",
            header=True,
            max_files_per_trigger=quarter_of(order_files(spark, sf_dir)),
            archive_dir=f"{folder}/old",
        ).awaitTermination()
    swept = archive_committed(
        spark, landing, f"{folder}/metadata", f"{folder}/old", f"{folder}/list", f"{folder}/status"
    )
    data = read_table(spark, f"{folder}/data", data_schema(orders))
    audited = read_table(spark, f"{folder}/metadata", metadata_schema(T.LongType()))
    csv = F.col(SOURCE_FILE).endswith(".csv")
    per_file = data.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("n"))
    counts = {
        "n_files": per_file.select(F.lit(1).alias("n")),
        "n_rows": per_file.select("n"),
        "n_audited": audited.select(F.lit(1).alias("n")),
        "n_audited_rows": audited.select(F.col(RECORD_COUNT).alias("n")),
        "n_swept": swept.filter(F.col("status") == MOVED).select(F.lit(1).alias("n")),
        "n_left": list_files(spark, landing).filter(csv).select(F.lit(1).alias("n")),
        "n_archived": list_files(spark, f"{folder}/old").filter(csv).select(F.lit(1).alias("n")),
    }
    labelled = [rows.select(F.lit(name).alias("of"), "n") for name, rows in counts.items()]
    return reduce(DataFrame.unionByName, labelled).agg(
        *(F.sum(F.when(F.col("of") == name, F.col("n")).otherwise(0)).alias(name) for name in counts)
    )


CONTAINER, ACCOUNT = "jobs", "acct"


def page_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses around the URL of each page, in the eight forms that rows of real logs mix.

    Our container; the same holding its own prefix and the scheme further on; other containers,
    accounts and schemes; near misses with a letter for a dot, an account that only begins like
    ours and another case; and the URL itself.
    """
    prefix = container_prefix(CONTAINER, ACCOUNT)
    url = F.col("url")
    forms = [
        F.concat(F.lit(prefix), url),
        F.concat(F.lit(f"{prefix}abfss/"), url, F.lit(f"/{prefix}in.csv")),
        F.concat(F.lit(container_prefix("other", ACCOUNT)), url),
        F.concat(F.lit(container_prefix(CONTAINER, "acct2")), url),
        F.concat(F.lit(f"abfs://{CONTAINER}@{ACCOUNT}.dfs.core.windows.net/"), url),
        F.concat(F.lit(f"abfss://{CONTAINER}@{ACCOUNT}Xdfs.core.windows.net/"), url),
        F.concat(F.lit(f"ABFSS://{CONTAINER}@{ACCOUNT}.dfs.core.windows.net/"), url),
        url,
    ]
    form = F.pmod("page_id", F.lit(len(forms)))
    address = F.element_at(F.array(*forms), (form + 1).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", address.alias("uri"))


def storage_uri_to_blob_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_addresses(spark, sf_dir).select("page_id", blob_url("uri").alias("url"))


def strip_container_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = strip_prefix("uri", container_prefix(CONTAINER, ACCOUNT))
    return page_addresses(spark, sf_dir).select("page_id", path.alias("file_path"))


QUERIES = {
    "csv_stream_ingest": csv_stream_ingest,
    "csv_permissive_nulls": csv_permissive_nulls,
    "ingest_rate_limited": ingest_rate_limited,
    "stamp_provenance": stamp_provenance,
    "processed_date_from_time": processed_date_from_time,
    "partitioned_sink_prune": partitioned_sink_prune,
    "clean_source_archive": clean_source_archive,
    "storage_uri_to_blob_url": storage_uri_to_blob_url,
    "strip_container_prefix": strip_container_prefix,
}
