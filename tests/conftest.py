import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import local_session

    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "4",
        **{
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """A frame from a DDL schema and tuples."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)
