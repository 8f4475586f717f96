import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from varve.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoint"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SMALL


@pytest.fixture
def values(spark):
    """Values of one column expression over rows of one or more columns."""

    def run(rows, schema, *columns):
        out = [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]
        return [r[0] for r in out] if len(columns) == 1 else out

    return run
