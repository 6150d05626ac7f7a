import pytest

from headway.catalog.check import session


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture
def frame(spark):
    """Rows and a schema string to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def values(df, *columns):
    """Collected rows of the columns, ordered by all of them."""
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda r: [(v is None, v if v is not None else 0) for v in r])
