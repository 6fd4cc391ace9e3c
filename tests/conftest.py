import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from storyloom.session import session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "3",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
    })
    made.sparkContext.setLogLevel("ERROR")
    shared_dir(made)
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
