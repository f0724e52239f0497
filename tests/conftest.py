import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobtide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply column rules to literal rows and give back plain values."""
    def run(rows, schema, *columns):
        out = spark.createDataFrame(rows, schema).select(*columns).collect()
        return [tuple(r) if len(r) > 1 else r[0] for r in out]

    return run
