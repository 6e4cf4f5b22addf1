import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from martwright.session import local_session

    session = local_session(
        "tests",
        cores=4,
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Small frame from rows and a DDL schema."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)
