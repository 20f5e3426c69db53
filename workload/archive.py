"""Queries over the archive of one date."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.stamps import with_processed_date
from tideline.functions.uri import container_prefix
from tideline.operators.archive import candidates
from tideline.operators.mover import run_moves
from tideline.plans.jobs import archive_date
from tideline.schemas import (
    FILE_PATH,
    FILES,
    PROCESSED_DATE,
    PROCESSING_TIME,
    SOURCE_FILE,
)
from tideline.scratch import new_folder
from tideline.sources.inventory import list_files
from tideline.sources.manifest import adopt_date, files_read_on
from tideline.sources.tables import read_slice
from workload.ingest import ACCOUNT, CONTAINER, ONE_DATE
from workload.landing import LANDING_KEY, landing_key, once, own_landed_orders, table

PREFIX = container_prefix(CONTAINER, ACCOUNT)


def _files_read(spark: SparkSession, sf_dir: str, name: str, viewed: bool) -> str:
    """A stored table of files read: the events of one kind, each user being a file."""
    is_view = F.col("event_type") == "view"

    def write(folder: str) -> None:
        (
            table(spark, sf_dir, "events")
            .filter(is_view if viewed else ~is_view)
            .select(
                F.concat(F.lit(f"{PREFIX}landing/"), "user_id", F.lit(".csv")).alias(SOURCE_FILE),
                F.col("ts").alias(PROCESSING_TIME),
            )
            .transform(with_processed_date)
            .hint("rebalance", PROCESSED_DATE)
            .write.partitionBy(PROCESSED_DATE)
            .parquet(folder)
        )

    return once(spark, sf_dir, name, write)


def data_path(spark: SparkSession, sf_dir: str) -> str:
    """DATA of files read, rows written by other means, with the manifest it was given since."""

    def adopt(folder: str) -> None:
        adopt_date(spark, path, ONE_DATE)

    path = _files_read(spark, sf_dir, "files-loaded", viewed=True)
    once(spark, sf_dir, "files-loaded-manifest", adopt)
    return path


def metadata_path(spark: SparkSession, sf_dir: str) -> str:
    return _files_read(spark, sf_dir, "files-audited", viewed=False)


def archive_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = {PROCESSED_DATE: ONE_DATE}
    data = files_read_on(spark, data_path(spark, sf_dir), ONE_DATE)
    metadata = read_slice(spark, metadata_path(spark, sf_dir), FILES, **day)
    return candidates(data, metadata, ONE_DATE)


def archive(
    spark: SparkSession, sf_dir: str, folder: str, limit: int = -1, run: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The report and the move list of one run on one date, as stored below `folder`."""
    moves = f"{folder}/move-list-{run}"
    report = archive_date(
        spark,
        data_path(spark, sf_dir),
        metadata_path(spark, sf_dir),
        f"{folder}/report",
        moves,
        ONE_DATE,
        PREFIX,
        limit,
        run=run,
    )
    return report, spark.read.text(moves).withColumnRenamed("value", FILE_PATH)


def archive_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(spark, sf_dir, new_folder(spark, "archive"))[0]


def archive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(spark, sf_dir, new_folder(spark, "archive"))[1]


def archive_manifest_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capped runs until nothing is left: the run that lists each file."""
    folder = new_folder(spark, "archive")
    # A cap of a third, rounded up: three runs with files and one that finds none, at any size.
    cap = math.ceil(archive_candidates(spark, sf_dir).count() / 3)
    runs = []
    while True:
        listed = archive(spark, sf_dir, folder, max(1, cap), len(runs))[1]
        if listed.isEmpty():
            break
        runs.append(listed.withColumn("run", F.lit(len(runs))))
    return reduce(DataFrame.unionByName, runs, listed.withColumn("run", F.lit(-1)))


def archive_move_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Move every landed file and one that is not there."""
    landing = own_landed_orders(spark, sf_dir)
    folder = new_folder(spark, "moves")
    listed = list_files(spark, landing).select(SOURCE_FILE)
    files = listed.filter(F.col(SOURCE_FILE).endswith(".csv"))
    missing = files.select(
        F.regexp_replace(SOURCE_FILE, rf"{LANDING_KEY}=\d+", f"{LANDING_KEY}=0").alias(SOURCE_FILE)
    )
    missing = missing.orderBy(SOURCE_FILE).limit(1)
    status = run_moves(
        files.unionByName(missing), f"{folder}/archive", f"{folder}/files", f"{folder}/status"
    )
    # Where each file lies afterwards, by listings of both folders.
    places = [
        list_files(spark, place).filter(F.col(SOURCE_FILE).endswith(".csv")).select(
            landing_key(SOURCE_FILE).alias("key"), F.lit(archived).alias("archived")
        )
        for place, archived in ((landing, 0), (f"{folder}/archive", 1))
    ]
    found = places[0].unionByName(places[1]).groupBy("key").agg(
        F.sum("archived").alias("n_archived"),
        F.sum(1 - F.col("archived")).alias("n_landed"),
    )
    moved = status.select(
        landing_key(FILE_PATH).alias("key"),
        "status",
        F.col("exception").isNotNull().alias("has_exception"),
    )
    return moved.join(found, "key", "left").select(
        F.col("key").alias(LANDING_KEY),
        "status",
        "has_exception",
        F.coalesce("n_archived", F.lit(0)).alias("n_archived"),
        F.coalesce("n_landed", F.lit(0)).alias("n_landed"),
    )


QUERIES = {
    "archive_candidates": archive_candidates,
    "archive_report": archive_report,
    "archive_manifest": archive_manifest,
    "archive_manifest_capped": archive_manifest_capped,
    "archive_move_status": archive_move_status,
}
