from __future__ import annotations

import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from tideline.scratch import CHECKPOINT_DIR, new_folder


def session(settings, master):
    conf = SimpleNamespace(get=lambda name, default: settings.get(name, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_folders_lie_below_the_shared_folder():
    cluster = session({CHECKPOINT_DIR: "hdfs://n/ck/"}, "yarn")
    first, second = new_folder(cluster, "load"), new_folder(cluster, "load")
    assert first.startswith("hdfs://n/ck/tideline/load-") and first != second


def test_only_a_single_jvm_may_use_a_temporary_folder():
    assert "tideline" in new_folder(session({}, "local[8]"), "load")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://n:7077"):
        with pytest.raises(ValueError):
            new_folder(session({}, master), "load")


PROGRAM = """
import sys
from pyspark.sql import SparkSession
from tideline.operators.archive import first_files
from tideline.sources.inventory import list_files
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
)
files = spark.range(20).selectExpr("concat('f', id) AS source_file")
assert first_files(files, 3).count() == 3 and list_files(spark, sys.argv[1]).count() > 0
from pathlib import Path
assert len(list(Path(sys.argv[1], "tideline").iterdir())) == 2
spark.stop()
"""


def test_intermediate_tables_go_with_the_program(tmp_path):
    root = Path(__file__).resolve().parents[1]
    command = [sys.executable, "-c", PROGRAM, str(tmp_path)]
    done = subprocess.run(command, cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert list((tmp_path / "tideline").iterdir()) == []
