from __future__ import annotations

import os
import time

import pytest
from conftest import ANN, BO, land, rows_of
from pyspark.sql import types as T

from tideline.plans.jobs import (
    archive_committed,
    start_audit,
    start_load,
    start_load_and_audit,
)
from tideline.schemas import FILES, LOANS, data_schema, metadata_schema
from tideline.sources.landing import CLEANER_THREADS, read_landing, source_cleaner
from tideline.sources.tables import read_table
from tideline.streaming.sinks import UNTIL_DONE, checkpoint_for


METADATA = metadata_schema(T.IntegerType())


def load(spark, landing, out, header=True, **options):
    query = start_load(
        spark, str(landing), LOANS, f"{out}/data", f"{out}/checkpoint",
        trigger=UNTIL_DONE, header=header, **options,
    )
    query.awaitTermination()
    return read_table(spark, f"{out}/data", data_schema(LOANS))


def names_and_ids(data):
    return rows_of(data.select("name", "age", "first_time_buyer", "loan_id"))


def test_rows_are_stamped_with_file_time_and_date(spark, landing, tmp_path):
    data = load(spark, landing, tmp_path)
    assert data.schema == data_schema(LOANS)
    counts = data.groupBy("source_file").count().collect()
    files = {row.source_file.rsplit("/", 1)[1]: row["count"] for row in counts}
    assert files == {"a.csv": 2, "b.csv": 1, "f%200.csv": 3}
    dates = data.selectExpr("processed_date = date_format(processing_time, 'yyyy-MM-dd') AS same")
    assert {row.same for row in dates.collect()} == {True}
    assert data.select("processing_time").distinct().count() == 1


def test_bad_cells_and_short_rows_become_nulls(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    land(folder / "x.csv", "bad,xx,maybe,1.0,1,1,1,p,t,zz", "short,1")
    data = load(spark, folder, tmp_path)
    assert names_and_ids(data) == [("bad", None, None, None), ("short", 1, None, None)]
    short = data.filter("name = 'short'").first()
    assert [short[c] for c in LOANS.names[2:]] == [None] * 8


def test_columns_are_positional_whatever_the_header_says(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    land(folder / "x.csv", ANN, header="WRONG,age")
    assert names_and_ids(load(spark, folder, tmp_path)) == [("Ann", 34, True, 1)]


def test_files_without_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    land(folder / "x.csv", ANN, BO, header=None)
    data = load(spark, folder, tmp_path, header=False)
    assert names_and_ids(data) == [("Ann", 34, True, 1), ("Bo", 51, False, 2)]


def test_hidden_files_are_not_read(spark, landing, tmp_path):
    land(landing / "_hidden.csv", ANN)
    land(landing / ".hidden.csv", ANN)
    assert load(spark, landing, tmp_path).count() == 6


@pytest.mark.parametrize("limit", [-1, 0, 1, 3])
def test_any_rate_limit_gives_the_same_rows(spark, landing, tmp_path, limit):
    data = load(spark, landing, tmp_path, max_files_per_trigger=limit)
    assert sorted(row.loan_id for row in data.collect()) == [1, 2, 2, 3, 4, 5]


def test_restart_reads_only_what_landed_since(spark, landing, tmp_path):
    assert load(spark, landing, tmp_path).count() == 6
    land(landing / "later.csv", ANN)
    data = load(spark, landing, tmp_path)
    assert data.count() == 7
    assert data.select("processing_time").distinct().count() == 2


def test_each_job_and_folder_has_its_own_checkpoint():
    assert checkpoint_for("/ck/", "load", "file:/land/in0/") == "/ck/load/land/in0"
    here, there = (
        checkpoint_for("hdfs://n:8020/ck", "audit", f"abfss://{c}@a.dfs.core.windows.net/in0")
        for c in ("here", "there")
    )
    assert here == "hdfs://n:8020/ck/audit/here@a.dfs.core.windows.net/in0" != there


def test_transform_hook_replaces_the_derived_columns(spark, landing, tmp_path):
    def by_type(df):
        return df.selectExpr("*", "coalesce(loan_type, 'none') AS kind")

    query = start_load(
        spark, str(landing), LOANS, f"{tmp_path}/data", f"{tmp_path}/checkpoint",
        partition_by="kind", trigger=UNTIL_DONE, transform=by_type, header=True,
    )
    query.awaitTermination()
    folders = [p for p in (tmp_path / "data").rglob("kind=*")]
    assert sorted(p.name for p in folders) == ["kind=fixed", "kind=none", "kind=variable"]
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in folders)


def test_the_joint_job_goes_on_with_a_loaded_table(spark, landing, tmp_path):
    load(spark, landing, tmp_path, partition_by="loan_type")
    land(landing / "later.csv", ANN)
    start_load_and_audit(
        spark, str(landing), LOANS, f"{tmp_path}/data", f"{tmp_path}/metadata",
        f"{tmp_path}/checkpoint", "age", trigger=UNTIL_DONE, header=True, partition_by="loan_type",
        metadata_partition_by="record_count",
    ).awaitTermination()
    assert read_table(spark, f"{tmp_path}/data", FILES).count() == 6 + 7
    audited = read_table(spark, f"{tmp_path}/metadata", METADATA)
    assert sorted(row.record_count for row in audited.collect()) == [0, 1, 1, 2, 3]


def test_a_table_with_a_foreign_log_is_refused(spark, landing, tmp_path):
    (tmp_path / "data" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="log of a streaming sink"):
        load(spark, landing, tmp_path)


def test_source_archiving_beside_another_reader_is_refused(spark, landing, tmp_path):
    with pytest.raises(ValueError, match="sole_reader"):
        load(spark, landing, tmp_path, archive_dir=f"{tmp_path}/old")
    with pytest.raises(ValueError, match="joint job"):
        start_audit(
            spark, str(landing), LOANS, f"{tmp_path}/metadata", f"{tmp_path}/checkpoint", "age",
            archive_dir=f"{tmp_path}/old",
        )


def test_finished_files_are_archived_one_batch_late(spark, landing, tmp_path):
    with source_cleaner(spark, cleanup_delay="60s", threads=0):
        query = start_load(
            spark, str(landing), LOANS, f"{tmp_path}/data", f"{tmp_path}/checkpoint",
            trigger=UNTIL_DONE, header=True, max_files_per_trigger=1,
            archive_dir=str(tmp_path / "old"), sole_reader=True,
        )
    query.awaitTermination()
    assert spark.conf.get(CLEANER_THREADS) == "1"
    assert len(list(landing.glob("*.csv"))) == 1
    assert len(list((tmp_path / "old").rglob("*.csv"))) == 3


def test_committed_files_are_swept_to_where_cleaning_puts_them(spark, landing, tmp_path):
    paths = f"{tmp_path}/data", f"{tmp_path}/metadata"
    with source_cleaner(spark, cleanup_delay="60s", threads=0):
        start_load_and_audit(
            spark, str(landing), LOANS, *paths, f"{tmp_path}/checkpoint", "age",
            trigger=UNTIL_DONE, header=True, max_files_per_trigger=2, archive_dir=f"{tmp_path}/old",
        ).awaitTermination()
    assert len(list(landing.glob("*.csv"))) == 2
    land(landing / "later.csv", ANN)
    sweep = f"{tmp_path}/old", f"{tmp_path}/list", f"{tmp_path}/status"
    status = archive_committed(spark, str(landing), paths[1], *sweep)
    assert [row.status for row in status.collect()] == ["success"] * 2
    assert [p.name for p in landing.glob("*.csv")] == ["later.csv"]
    kept = tmp_path / "old" / str(landing).lstrip("/")
    assert len(list((tmp_path / "old").rglob("*.csv"))) == len(list(kept.glob("*.csv"))) == 4


def test_no_archive_without_a_folder(spark, landing):
    assert read_landing(spark, str(landing), LOANS).columns == LOANS.names


def test_a_file_with_an_old_time_is_read(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    row = "{},30,true,0.5,1000,12,2.0,car,fixed,{}"
    now = time.time()
    for number, age_days in enumerate((0, 0, 30)):
        file = folder / f"{number}.csv"
        land(file, row.format(f"n{number}", number))
        os.utime(file, (now - age_days * 86_400,) * 2)
        data = load(spark, folder, tmp_path, max_file_age="36500d")
    assert rows_of(data.select("name")) == [("n0",), ("n1",), ("n2",)]


def test_the_driver_remembers_a_week_of_files(spark, tmp_path):
    """A file older than that is left to `load_late_files`; the first batch takes any."""
    folder = tmp_path / "in"
    folder.mkdir()
    row = "{},30,true,0.5,1000,12,2.0,car,fixed,{}"
    now = time.time()
    for number, age_days in enumerate((30, 0, 5, 30)):
        file = folder / f"{number}.csv"
        land(file, row.format(f"n{number}", number))
        os.utime(file, (now - age_days * 86_400,) * 2)
        data = load(spark, folder, tmp_path)
    assert rows_of(data.select("name")) == [("n0",), ("n1",), ("n2",)]
