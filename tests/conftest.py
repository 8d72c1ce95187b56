import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8, **{"spark.sql.shuffle.partitions": "4", "spark.sql.streaming.metricsEnabled": "false"}
    )
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows to DataFrame: table([(..)], "a bigint, b string")."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def collected():
    return lambda df, *columns: sorted(tuple(r) for r in df.select(*columns or df.columns).collect())
