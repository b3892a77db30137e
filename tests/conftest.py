import pytest

from tidemill.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """Rows of a frame as sorted tuples."""

    def rows(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in found.collect()), key=repr)

    return rows
