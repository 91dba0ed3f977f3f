import pytest

from tidemark.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def sliced(spark):
    """Treat groups of more than 30 rows as too large for one task."""
    spark.conf.set("spark.tidemark.rowsPerTask", "30")
    yield
    spark.conf.unset("spark.tidemark.rowsPerTask")


@pytest.fixture
def small():
    return SMALL
