from __future__ import annotations

from pathlib import Path

from conftest import land
from pyspark.sql import functions as F

from tideline.operators.mover import run_moves
from tideline.schemas import LOANS, MOVE_STATUS


def sources(spark, folder):
    read = spark.read.schema(LOANS).csv(str(folder))
    return read.select(F.col("_metadata.file_path").alias("source_file")).distinct()


def test_files_move_and_each_has_a_status(spark, landing, tmp_path):
    gone = spark.createDataFrame([(f"file:{landing}/gone.csv",)], "source_file string")
    listed = sources(spark, landing).union(gone)
    status = run_moves(
        listed, str(tmp_path / "old"), str(tmp_path / "list"), str(tmp_path / "status"), tasks=3
    )
    assert status.schema == MOVE_STATUS
    rows = {row.file_path.rsplit("/", 1)[1]: row for row in status.collect()}
    assert {n for n, r in rows.items() if r.status == "success"} == {
        "a.csv", "b.csv", "f%200.csv", "empty.csv",
    }
    assert rows["gone.csv"].status == "failed"
    assert "FileNotFoundError" in rows["gone.csv"].exception
    assert all(row.exception is None for row in rows.values() if row.status == "success")
    assert all(row.moved_datetime is not None for row in rows.values())
    assert list(landing.glob("*.csv")) == []
    moved = tmp_path / "old" / str(landing).lstrip("/")
    assert {p.name for p in moved.glob("*.csv")} == {"a.csv", "b.csv", "f 0.csv", "empty.csv"}


def test_a_repeated_move_is_a_success_and_never_overwrites(spark, landing, tmp_path):
    names = [(f"file:{landing}/a.csv",)]
    one = spark.createDataFrame(names, "source_file string")
    archive = tmp_path / "old"
    target = Path(f"{archive}{landing}/a.csv")
    files = str(tmp_path / "list")
    first = run_moves(one, str(archive), files, str(tmp_path / "s1")).collect()
    again = run_moves(one, str(archive), files, str(tmp_path / "s2")).collect()
    assert [r.status for r in first + again] == ["success", "success"]
    before = target.read_text()
    land(landing / "a.csv", "New,1")
    clash = run_moves(one, f"file:{archive}", files, str(tmp_path / "s3")).first()
    assert clash.status == "failed" and "FileExistsError" in clash.exception
    assert target.read_text() == before
    assert (landing / "a.csv").exists()


def test_a_run_repeated_goes_by_its_list_and_has_one_row_per_file(spark, landing, tmp_path):
    args = str(tmp_path / "old"), str(tmp_path / "list"), str(tmp_path / "status")
    listed = sources(spark, landing)
    first = run_moves(listed, *args)
    assert first.count() == 4
    # The listing is empty by now; half of the first run's outcome is undone.
    moved = tmp_path / "old" / str(landing).lstrip("/")
    (moved / "a.csv").rename(landing / "a.csv")
    again = run_moves(sources(spark, landing), *args)
    assert again.count() == 4 and {row.status for row in again.collect()} == {"success"}
    assert list(landing.glob("*.csv")) == []
    land(landing / "g.csv", "New,1")
    assert run_moves(sources(spark, landing), *args, run=1).count() == 1


def test_moves_by_copy_are_taken_up_wherever_they_stopped(spark, tmp_path):
    """Four files, each left as an attempt that stopped at another step leaves it."""
    folder, archive = tmp_path / "in", tmp_path / "old"
    folder.mkdir()
    target = Path(f"{archive}{folder}")
    target.mkdir(parents=True)
    names = ["fresh", "half", "published", "deleted", "untouched", "other"]
    for name in names:
        land(folder / f"{name}.csv", f"{name},1")
    text = {name: (folder / f"{name}.csv").read_text() for name in names}
    (target / ".half.csv.moving").write_text(text["half"][:3])
    (target / "published.csv").write_text(text["published"])
    (target / ".published.csv.moving").write_text(text["published"])
    (folder / "deleted.csv").rename(target / "deleted.csv")
    # As long as the source, but not the same.
    (target / "other.csv").write_text(text["other"].replace("1", "2"))
    listed = spark.createDataFrame([(f"file:{folder}/{n}.csv",) for n in names], "source_file string")
    status = run_moves(
        listed, str(archive), str(tmp_path / "list"), str(tmp_path / "status"), in_one_step=False
    )
    rows = {row.file_path.rsplit("/", 1)[1]: row for row in status.collect()}
    assert {name for name, row in rows.items() if row.status == "failed"} == {"other.csv"}
    assert "FileExistsError" in rows["other.csv"].exception
    assert [p.name for p in folder.iterdir()] == ["other.csv"]
    assert sorted(p.name for p in target.iterdir()) == sorted(f"{name}.csv" for name in names)
    assert all((target / f"{n}.csv").read_text() == text[n] for n in names if n != "other")


def test_an_equal_target_finishes_a_move_by_rename_too(spark, landing, tmp_path):
    archive = tmp_path / "old"
    target = Path(f"{archive}{landing}")
    target.mkdir(parents=True)
    (target / "a.csv").write_text((landing / "a.csv").read_text())
    one = spark.createDataFrame([(f"file:{landing}/a.csv",)], "source_file string")
    row = run_moves(one, str(archive), str(tmp_path / "list"), str(tmp_path / "status")).first()
    assert row.status == "success" and not (landing / "a.csv").exists()
