import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session
    session = build_session("local[*]", app_name="quarry-tests", shuffle_partitions=8)
    yield session
    session.stop()


def plan_text(df) -> str:
    """The formatted physical plan (lists PushedFilters in full)."""
    jvm = df.sparkSession.sparkContext._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
