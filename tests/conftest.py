import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemart.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    from tidemart.plans.warehouse import Warehouse

    return Warehouse.over_tables(spark, SF_DIR)


@pytest.fixture
def rows(spark):
    """rows("a int, b string", (1, "x"), ...) -> DataFrame."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
