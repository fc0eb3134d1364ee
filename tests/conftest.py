import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lumentide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def plan():
    """Formatted physical plan of a DataFrame as text."""
    def text(df):
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return text
