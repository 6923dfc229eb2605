import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tripmill.session import get_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = get_session("tests", "local[8]", conf)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def plan_text(df) -> str:
    """The physical plan as ``explain`` prints it."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="session")
def plan():
    return plan_text
