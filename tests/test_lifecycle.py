"""The whole life of landed files, with files landing and moving away while the stream runs."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from conftest import LOANS_HEADER
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.mover import run_moves
from tideline.plans.jobs import archive_date, start_load_and_audit
from tideline.schemas import LOANS, data_schema, metadata_schema
from tideline.sources.tables import read_slice

ROWS_PER_FILE = 50


def land_whole(folder, number):
    """A file appears in the landing folder at once, by rename."""
    rows = "\n".join(
        f"p{i},{20 + i},true,0.5,1.5,12,2.5,car,fixed,{number * ROWS_PER_FILE + i}"
        for i in range(ROWS_PER_FILE)
    )
    hidden = folder / f"_{number}.csv"
    hidden.write_text(f"{LOANS_HEADER}\n{rows}\n")
    hidden.rename(folder / f"{number}.csv")


def test_files_land_load_and_leave_while_the_stream_runs(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    paths = {"data_path": f"{tmp_path}/data", "metadata_path": f"{tmp_path}/metadata"}

    def start():
        return start_load_and_audit(
            spark, str(landing), LOANS, **paths, checkpoint_root=f"{tmp_path}/checkpoints",
            first_column="age", tie_break=["loan_id"], header=True, max_files_per_trigger=2,
            trigger={"processingTime": "500 milliseconds"},
        )

    def today():
        return datetime.now(timezone.utc).date().isoformat()

    def archive(run):
        report = archive_date(
            spark, **paths, report_path=f"{tmp_path}/report", move_list_path=f"{tmp_path}/list",
            date=today(), prefix=f"file:{landing}/",
        )
        return run_moves(
            report, f"{tmp_path}/archive", f"{tmp_path}/moves-{run}", f"{tmp_path}/status-{run}", 2
        )

    day = today()
    query = start()
    for number in range(4):
        land_whole(landing, number)
    query.processAllAvailable()
    assert {row.status for row in archive(0).collect()} == {"success"}
    assert list(landing.glob("*.csv")) == []
    for number in range(4, 8):
        land_whole(landing, number)
        time.sleep(0.3)
    query.stop()  # at whatever point it is
    archive(1)
    query = start()
    land_whole(landing, 8)
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None

    data = read_slice(spark, paths["data_path"], data_schema(LOANS))
    metadata = read_slice(spark, paths["metadata_path"], metadata_schema(T.IntegerType()))
    ids = [row.loan_id for row in data.select("loan_id").collect()]
    assert sorted(ids) == list(range(9 * ROWS_PER_FILE))
    audited = metadata.agg(F.count(F.lit(1)), F.sum("record_count"), F.min("first_value")).first()
    assert tuple(audited) == (9, 9 * ROWS_PER_FILE, 20)
    if today() == day:  # a file is listed on the date it was read
        assert {row.status for row in archive(2).collect()} == {"success"}
        assert {p.name for p in (tmp_path / "archive").rglob("*.csv")} == {
            f"{number}.csv" for number in range(9)
        }
