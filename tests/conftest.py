import pytest

from cellshift.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a set-like sorted list of tuples."""

    def collect(df, *columns):
        return sorted(
            (tuple(r) for r in df.select(*columns or df.columns).collect()), key=lambda r: repr(r)
        )

    return collect
