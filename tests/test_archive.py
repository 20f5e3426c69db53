from __future__ import annotations

import pytest
from conftest import plan_of, rows_of
from pyspark.errors import AnalysisException

from tideline.operators import archive, order
from tideline.plans.jobs import archive_date, start_audit, start_load, start_load_and_audit
from tideline.schemas import FILES, LOANS, REPORT
from tideline.sources.manifest import adopt_date, files_read_on, read_manifest
from tideline.sources.tables import (
    iso_date,
    read_slice,
    read_table,
    replace_predicate,
    with_keys,
    write_slice,
)
from tideline.streaming.sinks import UNTIL_DONE

DAY = "2024-01-15"
PREFIX = "abfss://jobs@acct.dfs.core.windows.net/"


def files(spark, names, day=DAY):
    return spark.createDataFrame([(f"{PREFIX}in/{n}.csv", day) for n in names], FILES)


@pytest.fixture
def stored(spark, tmp_path):
    """DATA has a b c (a twice) and METADATA b c d on the day; both have z on another day."""
    for table, names in {"data": "aabc", "metadata": "bcd"}.items():
        for day, of_day in {DAY: names, "2024-01-16": "z"}.items():
            write_slice(files(spark, of_day, day), f"{tmp_path}/{table}", processed_date=day)
    return tmp_path


def run(spark, out, **options):
    return archive_date(
        spark, f"{out}/data", f"{out}/metadata", f"{out}/report", f"{out}/list", DAY, PREFIX,
        **options,
    )


def listed(spark, out):
    return sorted(row.value for row in spark.read.text(f"{out}/list").collect())


def test_report_and_move_list_of_a_day(spark, stored):
    report = run(spark, stored)
    assert report.schema == REPORT
    expected = [f"{PREFIX}in/b.csv", f"{PREFIX}in/c.csv"]
    assert sorted(row.source_file for row in report.collect()) == expected
    assert {row.processed_date.isoformat() for row in report.collect()} == {DAY}
    assert listed(spark, stored) == ["in/b.csv", "in/c.csv"]


def test_running_a_day_again_replaces_its_report_and_list(spark, stored):
    run(spark, stored)
    run(spark, stored)
    assert spark.read.schema(REPORT).parquet(f"{stored}/report").count() == 2
    assert len(listed(spark, stored)) == 2


def test_other_days_stay_in_the_report(spark, stored):
    earlier = files(spark, "z").select("source_file")
    write_slice(earlier, f"{stored}/report", processed_date="2024-01-14", run=0)
    run(spark, stored)
    assert spark.read.schema(REPORT).parquet(f"{stored}/report").count() == 3


def test_a_day_with_nothing_is_empty(spark, stored):
    report = archive_date(
        spark, f"{stored}/data", f"{stored}/metadata", f"{stored}/report", f"{stored}/list",
        "2023-12-31", PREFIX,
    )
    assert report.count() == 0 and listed(spark, stored) == []


def test_two_separate_jobs_and_only_committed_batches_count(spark, landing, tmp_path):
    land_options = {"trigger": UNTIL_DONE, "header": True}
    start_load(
        spark, str(landing), LOANS, f"{tmp_path}/data", f"{tmp_path}/ck", **land_options
    ).awaitTermination()
    start_audit(
        spark, str(landing), LOANS, f"{tmp_path}/metadata", f"{tmp_path}/ck", "age", **land_options
    ).awaitTermination()
    data = read_table(spark, f"{tmp_path}/data", FILES)
    (day,) = {row.processed_date for row in data.collect()}
    # A batch that died half-way leaves rows that are not committed; the audit saw the file.
    stray = files(spark, ["stray"], day)
    stray.drop("processed_date").write.parquet(
        f"{tmp_path}/data/processed_date={day}/stream_id=x/batch_id=0/_temporary/0/task"
    )
    write_slice(stray, f"{tmp_path}/metadata", processed_date=day, stream_id="x", batch_id=0)
    report = archive_date(
        spark, f"{tmp_path}/data", f"{tmp_path}/metadata", f"{tmp_path}/report",
        f"{tmp_path}/list", day, f"file:{landing}/",
    )
    assert report.count() == 3
    assert listed(spark, tmp_path) == ["a.csv", "b.csv", "f%200.csv"]


@pytest.mark.parametrize("date", ["2024-1-15", "15.01.2024", "2024-02-30", "", "2024-W03-1"])
def test_a_malformed_date_is_refused(spark, stored, date):
    with pytest.raises(ValueError):
        iso_date(date)


def test_candidate_forms_agree(spark, stored):
    data = read_slice(spark, f"{stored}/data", FILES, processed_date=DAY)
    metadata = read_slice(spark, f"{stored}/metadata", FILES, processed_date=DAY)
    left, right = archive.files_of(data, DAY), archive.files_of(metadata, DAY)
    ours = rows_of(archive.candidates(data, metadata, DAY))
    assert ours == rows_of(left.intersect(right)) == rows_of(left.join(right, "source_file"))


@pytest.mark.parametrize("limit, expected", [(-1, 2), (0, 0), (1, 1), (5, 2)])
def test_limit_on_files(spark, stored, limit, expected):
    report = run(spark, stored, limit=limit)
    assert report.count() == expected
    if limit == 1:
        assert listed(spark, stored) == ["in/b.csv"]


@pytest.mark.parametrize("limit", [1, 10, 499, 500, 777, 1000, 2000])
def test_limits_are_cut_by_range_and_stay_exact(spark, tmp_path, limit):
    # A third of the files share one folder, so the ranges are uneven.
    names = spark.range(1000).selectExpr(
        "concat(if(id % 3 = 0, 'hot', md5(string(id))), '/', id) AS source_file"
    )
    got = rows_of(archive.first_files(names, limit, f"{tmp_path}/staging"))
    assert got == sorted(rows_of(names), key=lambda r: r[0])[:limit]


def test_a_large_limit_needs_nothing_else(spark, stored):
    assert run(spark, stored, limit=200_000).count() == 2


def test_capped_runs_work_a_date_off_and_can_be_repeated(spark, tmp_path):
    for table in ("data", "metadata"):
        write_slice(files(spark, "abcdef"), f"{tmp_path}/{table}", processed_date=DAY)
    lists = []
    for number in range(4):
        run(spark, tmp_path, limit=2, run=number)
        lists.append(listed(spark, tmp_path))
    assert lists == [[f"in/{n}.csv" for n in pair] for pair in ("ab", "cd", "ef", "")]
    for number in (0, 2, 1):
        run(spark, tmp_path, limit=2, run=number)
        assert listed(spark, tmp_path) == lists[number]
    assert spark.read.schema(REPORT).parquet(f"{tmp_path}/report").count() == 6


def done(spark, out, names):
    for table in ("data", "metadata"):
        write_slice(files(spark, names), f"{out}/{table}", processed_date=DAY)


def test_files_that_are_done_later_come_after_the_end(spark, tmp_path):
    done(spark, tmp_path, "bdfh")
    lists = []
    for number, names in enumerate(("bdfh", "abcdefh", "abcdefh", "abcdefgh")):
        done(spark, tmp_path, names)
        run(spark, tmp_path, limit=3, run=number)
        lists.append(listed(spark, tmp_path))
    # b d f, then h and the later a c, then e; g came last.
    expected = ["bdf", "ach", "e", "g"]
    assert lists == [[f"in/{n}.csv" for n in names] for names in expected]
    assert spark.read.schema(REPORT).parquet(f"{tmp_path}/report").count() == 8


def test_runs_with_and_without_a_cap_take_each_file_once(spark, tmp_path):
    done(spark, tmp_path, "abcdef")
    taken = []
    for number, limit in enumerate((2, -1, 4, -1)):
        if number == 2:
            done(spark, tmp_path, "abcdefgh")
        run(spark, tmp_path, limit=limit, run=number)
        taken.append("".join(p[3] for p in listed(spark, tmp_path)))
    assert taken == ["ab", "cdef", "gh", ""]


def test_a_cap_after_a_run_without_one(spark, tmp_path):
    done(spark, tmp_path, "abc")
    run(spark, tmp_path)
    done(spark, tmp_path, "abcdefg")
    run(spark, tmp_path, limit=3, run=1)
    assert listed(spark, tmp_path) == ["in/d.csv", "in/e.csv", "in/f.csv"]


def test_the_order_is_sorted_once_and_cut_at_any_position(spark, tmp_path, monkeypatch):
    names = spark.range(900).selectExpr(
        "concat(if(id % 3 = 0, 'hot', md5(string(id))), '/', id) AS source_file"
    )
    expected = sorted(row[0] for row in names.collect())
    path = f"{tmp_path}/order"
    order.extend_order(names, path, DAY)
    monkeypatch.setattr(type(names), "repartitionByRange", None)
    first = 0
    for number, limit in enumerate((0, 1, 299, 300, 250, 1000)):
        got = order.slice_of_run(spark, path, DAY, number, limit)
        assert sorted(row[0] for row in got.collect()) == expected[first : first + limit]
        plan = plan_of(got)
        assert "Sort" not in plan and "rangepartitioning" not in plan
        first += limit


def test_an_extension_that_broke_off_is_made_again(spark, tmp_path, monkeypatch):
    path, whole = f"{tmp_path}/order", order.write_slice
    order.extend_order(files(spark, "ab"), path, DAY)

    def fails(rows, folder, *args, **keys):
        if folder.endswith("ranges"):
            raise RuntimeError("lost between rows and ranges")
        whole(rows, folder, *args, **keys)

    monkeypatch.setattr(order, "write_slice", fails)
    with pytest.raises(RuntimeError):
        order.extend_order(files(spark, "cdx"), path, DAY)
    monkeypatch.setattr(order, "write_slice", whole)
    order.extend_order(files(spark, "cd"), path, DAY)
    got = order.slice_of_run(spark, path, DAY, 0, -1).collect()
    assert sorted(row[0][-5] for row in got) == ["a", "b", "c", "d"]


def test_candidates_are_worked_out_from_files_and_not_from_rows(spark, landing, tmp_path):
    options = {"trigger": UNTIL_DONE, "header": True}
    start_load_and_audit(
        spark, str(landing), LOANS, f"{tmp_path}/data", f"{tmp_path}/metadata", f"{tmp_path}/ck",
        "age", **options,
    ).awaitTermination()
    (day,) = {row.processed_date for row in read_manifest(spark, f"{tmp_path}/data").collect()}
    data = files_read_on(spark, f"{tmp_path}/data", day)
    metadata = read_slice(spark, f"{tmp_path}/metadata", FILES, processed_date=day)
    found = archive.candidates(data, metadata, day)
    assert found.count() == 4
    places = {name.split("/processed_date=")[0] for name in found.inputFiles()}
    assert places == {f"file://{tmp_path}/data-files", f"file://{tmp_path}/metadata"}


def test_rows_written_without_a_manifest_are_adopted(spark, stored):
    data = f"{stored}/data"
    assert f"{data}/" in files_read_on(spark, data, DAY).inputFiles()[0]
    adopt_date(spark, data, DAY)
    adopt_date(spark, data, DAY)
    adopted = files_read_on(spark, data, DAY)
    assert rows_of(adopted) == [(f"{PREFIX}in/{n}.csv", DAY) for n in "abc"]
    assert "data-files" in adopted.inputFiles()[0]
    assert run(spark, stored).count() == 2
    # Dates without a manifest are read by their rows.
    assert files_read_on(spark, data, "2024-01-16").count() == 1


@pytest.mark.parametrize("wrong", ["data_path", "metadata_path"])
def test_a_table_that_is_not_there_is_an_error_and_replaces_nothing(spark, stored, wrong):
    run(spark, stored)
    paths = {"data_path": f"{stored}/data", "metadata_path": f"{stored}/metadata"}
    paths[wrong] = f"{stored}/mistyped"
    with pytest.raises(AnalysisException):
        archive_date(
            spark, **paths, report_path=f"{stored}/report", move_list_path=f"{stored}/list",
            date=DAY, prefix=PREFIX,
        )
    assert spark.read.schema(REPORT).parquet(f"{stored}/report").count() == 2
    assert len(listed(spark, stored)) == 2


def test_keys_of_table_formats_have_the_stored_types(spark):
    report = archive.report_rows(files(spark, "a"), DAY)
    keys = {"processed_date": DAY, "run": 3}
    kept = with_keys(report, keys)
    assert kept.schema["processed_date"].dataType == REPORT["processed_date"].dataType
    assert dict(kept.dtypes)["run"] == "bigint"
    predicate = replace_predicate(report.schema, keys)
    assert predicate == f"processed_date = DATE '{DAY}' AND run = 3"
    assert kept.filter(predicate).count() == 1
    own = {"processed_date": DAY, "stream_id": "o'k", "batch_id": 7}
    owned = with_keys(files(spark, "a"), own)
    assert [dict(owned.dtypes)[name] for name in own] == ["string", "string", "bigint"]
    assert owned.filter(replace_predicate(files(spark, "a").schema, own)).count() == 1


def test_a_slice_is_replaced_whole_and_leaves_others(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_slice(files(spark, "ab"), path, processed_date=DAY)
    write_slice(files(spark, "c", "2024-01-16"), path, processed_date="2024-01-16")
    write_slice(files(spark, "d"), path, processed_date=DAY)
    got = rows_of(read_slice(spark, path, FILES, processed_date=DAY))
    assert got == [(f"{PREFIX}in/d.csv", DAY)]
    assert spark.read.schema(FILES).parquet(path).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_slices_in_other_folder_formats(spark, tmp_path, fmt):
    path = f"{tmp_path}/t"
    write_slice(files(spark, "ab"), path, fmt, processed_date=DAY)
    assert read_slice(spark, path, FILES, fmt, processed_date=DAY).count() == 2
    assert read_slice(spark, path, FILES, fmt, processed_date="2020-01-01").count() == 0
