import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kerbside.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("tests", "local[4]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def plan(spark):
    """The physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
