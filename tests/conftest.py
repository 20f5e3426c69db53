from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


LOANS_HEADER = (
    "name,age,first_time_buyer,ltv,loan_amount,loan_term,interest_rate,"
    "loan_purpose,loan_type,loan_id"
)
ANN = "Ann,34,true,0.8,250000.5,360,3.25,home,fixed,1"
BO = "Bo,51,false,0.6,90000,180,4.5,refinance,variable,2"


@pytest.fixture
def landing(tmp_path):
    """Four landed files: two plain, one with a space in its name, one with a header alone."""
    folder = tmp_path / "landing"
    folder.mkdir()
    land(folder / "a.csv", ANN, BO)
    land(folder / "b.csv", "Cy,29,true,0.7,1000,12,2.5,car,fixed,3")
    land(folder / "f 0.csv", "Di,40,false,0.5,2000,24,2.0,car,fixed,4", "Ed,41,,,,,,,,5", BO)
    land(folder / "empty.csv")
    return folder


def land(path: Path, *rows: str, header: str | None = LOANS_HEADER) -> None:
    lines = ([header] if header else []) + list(rows)
    path.write_text("\n".join(lines) + "\n")


def plan_of(df) -> str:
    """The physical plan, formatted."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
