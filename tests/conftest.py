import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sluiceworks.session import session

    s = session(
        app="tests",
        master="local[8]",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="6g",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
