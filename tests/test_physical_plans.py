"""The plans that must hold at scale: pruned scans, one shuffle, reduction ahead of it."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.archive import candidates
from tideline.operators.audit import (
    audit_rows,
    latest_per_file,
    latest_per_file_by_window,
    record_counts,
)
from tideline.schemas import LOANS, loaded_schema
from tideline.sources.tables import read_slice, read_table, write_slice

DAY = "2024-01-15"
SCHEMA = loaded_schema(LOANS)


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "data")
    for day in (DAY, "2024-01-16"):
        rows = spark.range(20).select(
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in LOANS.fields[:-1]),
            F.col("id").cast("int").alias("loan_id"),
            F.concat(F.lit("file:/in/"), F.col("id") % 3).alias("source_file"),
            F.lit(1).cast("long").alias("source_file_size"),
            F.current_timestamp().alias("source_file_modification_time"),
            F.current_timestamp().alias("processing_time"),
        )
        write_slice(rows, path, processed_date=day, stream_id="s", batch_id=0)
    return path


def executed(df):
    df.collect()
    return plan_of(df)


def read_schemas(plan):
    return re.findall(r"ReadSchema: struct<(.*)>", plan)


def test_audit_is_one_hash_aggregation(spark, data):
    batch = read_slice(spark, data, SCHEMA, processed_date=DAY, stream_id="s", batch_id=0)
    plan = plan_of(audit_rows(batch, "age", ["loan_id"]))
    tree = plan.split("\n\n")[0]
    assert tree.count("HashAggregate") == 2 and tree.count("Exchange") == 1
    assert "Sort" not in tree and "Join" not in tree and "Window" not in tree
    assert read_schemas(plan) == [
        "age:int,loan_id:int,source_file:string,source_file_size:bigint,"
        "source_file_modification_time:timestamp,processing_time:timestamp"
    ]


def test_counts_are_partial_ahead_of_the_shuffle(spark, data):
    plan = plan_of(record_counts(read_table(spark, data, SCHEMA)))
    assert "partial_count" in plan
    assert read_schemas(plan) == ["source_file:string,processing_time:timestamp"]


def test_latest_row_is_reduced_ahead_of_its_one_shuffle(spark, data):
    args = (read_table(spark, data, SCHEMA), ["source_file", "age"], ["loan_id"])
    tree = plan_of(latest_per_file(*args)).split("\n\n")[0]
    steps = re.findall(r"SortAggregate|Exchange|Window", tree)
    assert steps == ["SortAggregate", "Exchange", "SortAggregate"]
    tree = plan_of(latest_per_file_by_window(*args)).split("\n\n")[0]
    steps = re.findall(r"WindowGroupLimit|Exchange", tree)
    assert steps == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_a_slice_lists_only_its_own_folder(spark, data):
    day = read_slice(spark, data, SCHEMA, processed_date=DAY)
    assert {f"processed_date={DAY}" in name for name in day.inputFiles()} == {True}
    assert day.count() == 20


def test_date_filter_prunes_partitions_and_columns(spark, data):
    day = read_table(spark, data, SCHEMA).filter(F.col("processed_date") == DAY)
    plan = plan_of(day.select("source_file"))
    assert re.search(r"PartitionFilters: \[.*processed_date.* = 2024-01-15", plan)
    assert read_schemas(plan) == ["source_file:string"]


def test_candidates_shuffle_one_row_per_file_and_keep_the_partitioning(spark, data):
    both = read_table(spark, data, SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(candidates(both, both, DAY))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = plan.split("\n\n")[0]
    assert "LeftSemi" in plan
    assert tree.count("Exchange") <= 2
    assert set(read_schemas(plan)) == {"source_file:string"}


def test_no_python_in_the_row_path(spark, data):
    batch = read_table(spark, data, SCHEMA)
    plans = [
        plan_of(audit_rows(batch, "age", ["loan_id"])),
        plan_of(latest_per_file(batch, ["source_file"], ["loan_id"])),
        plan_of(candidates(batch, batch, DAY)),
    ]
    assert not any("Python" in plan or "Pandas" in plan for plan in plans)


def test_sample_types(spark, data):
    batch = read_table(spark, data, SCHEMA)
    assert audit_rows(batch, "name", ["loan_id"]).schema["first_value"].dataType == T.StringType()
