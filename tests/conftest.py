import pytest

from tripmart.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = local_session(8, "tests", **folders)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Builds a small DataFrame from a schema text and tuples."""
    return lambda schema, *values: spark.createDataFrame(list(values), schema)
