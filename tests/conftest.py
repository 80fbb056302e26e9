import pytest

from siltline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, NULLs last."""
    def collect(df):
        return sorted(
            (tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r]
        )
    return collect
