from __future__ import annotations

import os
import time

import pytest
from conftest import ANN, BO, land, rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.audit import (
    audit_rows,
    audit_rows_by_join,
    latest_per_file,
    latest_per_file_by_window,
)
from tideline.plans.jobs import archive_date, load_late_files, start_audit, start_load_and_audit
from tideline.schemas import LOANS, data_schema, metadata_schema
from tideline.sources.landing import read_landing
from tideline.sources.manifest import read_manifest
from tideline.sources.tables import read_slice, read_table
from tideline.streaming import writers
from tideline.streaming.sinks import UNTIL_DONE, start_batches
from tideline.streaming.writers import load_and_audit_writer, loadable

METADATA = metadata_schema(T.IntegerType())


def load_and_audit(spark, landing, out, checkpoint="checkpoint", **options):
    query = start_load_and_audit(
        spark, str(landing), LOANS, f"{out}/data", f"{out}/metadata", f"{out}/{checkpoint}",
        "age", ["loan_id"], trigger=UNTIL_DONE, header=True, **options,
    )
    query.awaitTermination()
    return tables(spark, out)


def tables(spark, out):
    data = read_slice(spark, f"{out}/data", data_schema(LOANS))
    return data, read_slice(spark, f"{out}/metadata", METADATA)


def by_name(metadata):
    return {row.source_file.rsplit("/", 1)[1]: row for row in metadata.collect()}


def test_one_row_per_file_with_its_properties(spark, landing, tmp_path):
    data, metadata = load_and_audit(spark, landing, tmp_path)
    rows = by_name(metadata)
    assert {name: (r.record_count, r.first_value) for name, r in rows.items()} == {
        "a.csv": (2, 34), "b.csv": (1, 29), "f%200.csv": (3, 51), "empty.csv": (0, None),
    }
    for name, row in rows.items():
        path = landing / name.replace("%20", " ")
        assert row["size"] == path.stat().st_size
        assert abs(row.modification_time.timestamp() - path.stat().st_mtime) < 1
    assert metadata.schema == METADATA
    assert data.schema == data_schema(LOANS)


@pytest.mark.parametrize("limit", [1, 2, -1])
def test_counts_add_up_to_the_loaded_rows(spark, landing, tmp_path, limit):
    data, metadata = load_and_audit(spark, landing, tmp_path, max_files_per_trigger=limit)
    loaded = data.groupBy("source_file", "processed_date").count()
    audited = metadata.select("source_file", "processed_date", "record_count")
    assert audited.count() == 4
    audited = audited.filter("record_count > 0")
    assert rows_of(loaded) == rows_of(audited)
    assert audited.agg(F.sum("record_count")).first()[0] == 6


@pytest.mark.parametrize("by_join", [False, True])
def test_audit_alone_gives_the_same_rows(spark, landing, tmp_path, by_join):
    _, both = load_and_audit(spark, landing, tmp_path, empty_files=False)
    query = start_audit(
        spark, str(landing), LOANS, f"{tmp_path}/alone", f"{tmp_path}/checkpoint",
        "age", ["loan_id"], trigger=UNTIL_DONE, by_join=by_join, header=True,
    )
    query.awaitTermination()
    stable = ["source_file", "record_count", "size", "modification_time", "first_value"]
    alone = read_table(spark, f"{tmp_path}/alone", METADATA)
    assert rows_of(alone.select(stable)) == rows_of(both.select(stable))


@pytest.mark.parametrize("column", ["source_file", "processed_date", "processing_time"])
def test_a_stamp_column_can_be_the_sample(spark, landing, tmp_path, column):
    query = start_audit(
        spark, str(landing), LOANS, f"{tmp_path}/m", f"{tmp_path}/checkpoint", column,
        trigger=UNTIL_DONE, header=True,
    )
    query.awaitTermination()
    kind = data_schema(LOANS)[column].dataType
    rows = read_table(spark, f"{tmp_path}/m", metadata_schema(kind)).collect()
    assert len(rows) == 3 and all(row.first_value == row[column] for row in rows)


@pytest.mark.parametrize("by_join", [False, True])
def test_the_sample_can_keep_its_own_name(spark, landing, tmp_path, by_join):
    query = start_audit(
        spark, str(landing), LOANS, f"{tmp_path}/m", f"{tmp_path}/checkpoint", "age", ["loan_id"],
        trigger=UNTIL_DONE, header=True, first_name="age", by_join=by_join,
    )
    query.awaitTermination()
    rows = read_table(spark, f"{tmp_path}/m", metadata_schema(T.IntegerType(), "age"))
    assert sorted(row.age for row in rows.collect()) == [29, 34, 51]


@pytest.mark.parametrize("job", [start_audit, start_load_and_audit])
def test_the_sample_can_be_a_derived_column(spark, landing, tmp_path, job):
    paths = [f"{tmp_path}/data"] if job is start_load_and_audit else []
    query = job(
        spark, str(landing), LOANS, *paths, f"{tmp_path}/m", f"{tmp_path}/checkpoint", "years",
        ["loan_id"], trigger=UNTIL_DONE, header=True,
        transform=lambda df: df.withColumn("years", F.col("age") * 2),
    )
    query.awaitTermination()
    rows = read_table(spark, f"{tmp_path}/m", METADATA).collect()
    assert sorted(row.first_value for row in rows if row.record_count) == [58, 68, 102]


def test_a_small_batch_is_audited_into_one_file(spark, landing, tmp_path):
    load_and_audit(spark, landing, tmp_path)
    assert len(list((tmp_path / "metadata").rglob("*.parquet"))) == 1


def test_failed_batch_is_replayed_without_doubling(spark, landing, tmp_path):
    write = load_and_audit_writer(
        f"{tmp_path}/data", f"{tmp_path}/metadata", "age", ["loan_id"]
    )
    called = []

    def write_then_fail(batch, batch_id):
        write(batch, batch_id)
        called.append(batch_id)
        if called.count(1) == 1 and batch_id == 1:
            raise RuntimeError("lost after the writes")

    def run():
        stream = read_landing(spark, str(landing), LOANS, header=True, max_files_per_trigger=2)
        start_batches(
            loadable(stream), write_then_fail, f"{tmp_path}/checkpoint", "replay", UNTIL_DONE
        ).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert called == [0, 1, 1]
    data, metadata = tables(spark, tmp_path)
    assert data.count() == 6
    assert metadata.count() == 3


def test_a_batch_written_whole_outlives_the_archive_of_its_files(spark, landing, tmp_path):
    """The stream stops before a commit, its files are moved away, and it starts again."""

    def run(fail):
        # A new writer, as after a restart of the program.
        write = load_and_audit_writer(
            f"{tmp_path}/data", f"{tmp_path}/metadata", "age", ["loan_id"]
        )

        def on_batch(batch, batch_id):
            write(batch, batch_id)
            if fail:
                raise RuntimeError("lost before the commit")

        stream = read_landing(spark, str(landing), LOANS, header=True)
        start_batches(
            loadable(stream), on_batch, f"{tmp_path}/checkpoint", "outlive", UNTIL_DONE
        ).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(fail=True)
    (landing / "f 0.csv").rename(tmp_path / "archived.csv")
    land(landing / "later.csv", ANN)
    run(fail=False)
    data, metadata = tables(spark, tmp_path)
    assert (data.count(), metadata.count()) == (7, 4)


def test_a_batch_without_its_audit_is_written_again(spark, landing, tmp_path, monkeypatch):
    whole, calls = writers.audit_rows, []

    def fails_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("lost between the two tables")
        return whole(*args)

    monkeypatch.setattr(writers, "audit_rows", fails_once)
    with pytest.raises(StreamingQueryException):
        load_and_audit(spark, landing, tmp_path)
    data, metadata = load_and_audit(spark, landing, tmp_path)
    assert len(calls) == 2
    assert (data.count(), metadata.count()) == (6, 4)


def test_streams_share_tables_without_taking_each_others_batches(spark, landing, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    land(other / "z.csv", ANN)
    load_and_audit(spark, landing, tmp_path)
    data, metadata = load_and_audit(spark, other, tmp_path)
    assert (data.count(), metadata.count()) == (7, 5)
    # A stream begun anew reads its folder again and adds to what is there.
    data, metadata = load_and_audit(spark, other, tmp_path, checkpoint="fresh")
    assert (data.count(), metadata.count()) == (8, 6)


def test_landed_columns_may_be_named_like_file_properties(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("7,2020-01-01 00:00:00\n8,2020-01-02 00:00:00\n")
    schema = T.StructType.fromDDL("size int, modification_time timestamp")
    start_load_and_audit(
        spark, str(folder), schema, f"{tmp_path}/data", f"{tmp_path}/metadata", f"{tmp_path}/ck",
        "size", ["modification_time"], trigger=UNTIL_DONE,
    ).awaitTermination()
    row = read_table(spark, f"{tmp_path}/metadata", METADATA).first()
    assert (row["size"], row.first_value) == (44, 7)


def test_files_without_rows_are_audited_and_archived(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    land(folder / "header.csv")
    (folder / "line.csv").write_text("\n")
    data, metadata = load_and_audit(spark, folder, tmp_path)
    land(folder / "a.csv", ANN)
    data, metadata = load_and_audit(spark, folder, tmp_path)
    rows = by_name(metadata)
    assert {name: (r.record_count, r.first_value) for name, r in rows.items()} == {
        "header.csv": (0, None), "line.csv": (0, None), "a.csv": (1, 34)
    }
    assert rows["header.csv"]["size"] == (folder / "header.csv").stat().st_size
    assert data.count() == 1
    (day,) = {r.processed_date for r in rows.values()}
    report = archive_date(
        spark, f"{tmp_path}/data", f"{tmp_path}/metadata", f"{tmp_path}/report",
        f"{tmp_path}/list", day, f"file:{folder}/",
    )
    assert {r.source_file.rsplit("/", 1)[1] for r in report.collect()} == set(rows)


def test_files_without_rows_can_be_left_out(spark, landing, tmp_path):
    _, metadata = load_and_audit(spark, landing, tmp_path, empty_files=False)
    assert sorted(by_name(metadata)) == ["a.csv", "b.csv", "f%200.csv"]


def test_rows_of_a_batch_are_read_once(spark, landing, tmp_path):
    """A transform that drops nearly all rows must not be run over any of them twice."""
    seen = spark.sparkContext.accumulator(0)

    def look(age):
        seen.add(1)
        return age == 40

    data, metadata = load_and_audit(
        spark, landing, tmp_path, max_files_per_trigger=2,
        transform=lambda df: df.filter(F.udf(look, "boolean")("age")),
    )
    assert (data.count(), seen.value) == (1, 6)
    assert sorted(r.record_count for r in metadata.collect()) == [0, 0, 0, 1]


def test_names_with_pattern_signs_are_taken_as_they_stand(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    names = ["a[1].csv", "b{x,y}.csv", "c*?.csv", "d 50%+1.csv", "e#f.csv"]
    for name in names:
        land(folder / name, ANN)
    land(folder / "a1.csv", ANN, ANN)
    data, metadata = load_and_audit(spark, folder, tmp_path)
    assert (data.count(), metadata.count()) == (7, 6)
    assert sorted(r.record_count for r in metadata.collect()) == [1] * 5 + [2]


def aged(path, days):
    then = time.time() - days * 86_400
    os.utime(path, (then, then))


def test_late_files_are_loaded_and_audited_once(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    land(folder / "new.csv", ANN)
    load_and_audit(spark, folder, tmp_path)
    for name, days in (("old.csv", 30), ("older.csv", 40), ("empty.csv", 50), ("recent.csv", 1)):
        land(folder / name, *([BO] if "old" in name else [ANN] if name == "recent.csv" else []))
        aged(folder / name, days)

    def late(**options):
        return load_late_files(
            spark, str(folder), LOANS, f"{tmp_path}/data", f"{tmp_path}/metadata",
            f"{tmp_path}/checkpoint", "age", ["loan_id"], header=True, files_per_batch=2, **options
        )

    # What the stream has not come to yet is none of the late files' business.
    assert late(max_file_age="45d") == 1
    _, metadata = tables(spark, tmp_path)
    assert sorted(by_name(metadata)) == ["empty.csv", "new.csv"]
    data, metadata = load_and_audit(spark, folder, tmp_path)
    assert sorted(by_name(metadata)) == ["empty.csv", "new.csv", "recent.csv"]

    whole = writers.audit_rows

    def fails(*args):
        raise RuntimeError("lost between the two tables")

    monkeypatch.setattr(writers, "audit_rows", fails)
    with pytest.raises(RuntimeError):
        late()
    monkeypatch.setattr(writers, "audit_rows", whole)
    land(folder / "oldest.csv", BO)
    aged(folder / "oldest.csv", 60)
    assert late() == 3
    assert late() == 0
    data, metadata = load_and_audit(spark, folder, tmp_path)
    rows = by_name(metadata)
    assert {name: r.record_count for name, r in rows.items()} == {
        "new.csv": 1, "recent.csv": 1, "old.csv": 1, "older.csv": 1, "oldest.csv": 1, "empty.csv": 0
    }
    assert metadata.count() == 6 and data.count() == 5


def test_the_manifest_has_one_row_per_file_and_batch(spark, landing, tmp_path):
    data, metadata = load_and_audit(spark, landing, tmp_path, max_files_per_trigger=3)
    listed = read_manifest(spark, f"{tmp_path}/data")
    columns = ["source_file", "size", "modification_time", "processed_date", "stream_id", "batch_id"]
    assert listed.columns == columns
    audited = read_slice(spark, f"{tmp_path}/metadata", METADATA)
    assert rows_of(listed.select(columns)) == rows_of(audited.select(columns))


def stamped(spark, rows):
    schema = "source_file string, k int, v int, source_file_size long"
    return spark.createDataFrame(rows, schema).selectExpr(
        "*", "timestamp'2024-01-15 10:00:00' AS processing_time",
        "timestamp'2024-01-14 10:00:00' AS source_file_modification_time",
        "'2024-01-15' AS processed_date",
    )


MIXED = [
    ("a", 2, 20, 9), ("a", 1, 10, 9), ("a", None, 7, 9), ("a", None, 5, 9),
    ("b", 3, None, 9), ("b", 4, 40, 9), ("c", None, None, 9), ("d", 1, 1, 3_000_000_000),
]


@pytest.mark.parametrize("tie_break", [(), ("k",), ("k", "v")])
def test_aggregate_form_equals_join_form(spark, tie_break):
    df = stamped(spark, MIXED)
    aggregated, joined = (form(df, "v", tie_break) for form in (audit_rows, audit_rows_by_join))
    assert rows_of(aggregated) == rows_of(joined)


def test_sizes_above_two_gigabytes_stay_whole(spark):
    row = audit_rows(stamped(spark, MIXED), "v", ["k"]).filter("source_file = 'd'").first()
    assert row["size"] == 3_000_000_000


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "int", "double"])
def test_latest_row_equals_its_window_form(spark, kind):
    """Random rows; a third of them share one file. Clock changes of the zone must not matter."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # Hours around both clock changes of 2024, and some rows with no time.
        hours = "pmod(xxhash64(id, 1), 9)"
        spring, autumn = (
            kind_of(f"2024-{day} 22:00:00", kind) for day in ("03-09", "11-02")
        )
        start = f"if(id % 2 = 0, {spring}, {autumn})"
        step = {
            "timestamp": f"{start} + make_dt_interval(0, {hours}, id % 7 * 10)",
            "timestamp_ntz": f"{start} + make_dt_interval(0, {hours}, id % 7 * 10)",
            "date": f"date_add({start}, cast({hours} AS int))",
            "int": f"cast({hours} AS int)",
            "double": f"cast({hours} AS double)",
        }[kind]
        df = spark.range(4000).selectExpr(
            "if(id % 3 = 0, 'hot', concat('f', id % 50)) AS source_file",
            f"if(id % 11 = 0, NULL, {step}) AS t",
            "if(id % 13 = 0, NULL, cast(pmod(xxhash64(id, 2), 5) AS int)) AS k",
            "id",
        )
        args = (["source_file", "id", "t"], ["k", "id"])
        ours = latest_per_file(df, *args, time="t")
        window = latest_per_file_by_window(df, *args, time="t")
        assert ours.count() == 51
        assert ours.exceptAll(window).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def kind_of(text, kind):
    return f"cast('{text}' AS {kind})" if kind not in ("int", "double") else "0"


def test_latest_row_breaks_ties_by_the_given_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 9), ("a", 2, 3), ("b", 1, 1)], "source_file string, t int, id int"
    )
    newest = latest_per_file(df, ["source_file", "id"], ["id"], time="t")
    assert rows_of(newest) == [("a", 3), ("b", 1)]
