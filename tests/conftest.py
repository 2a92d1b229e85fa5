import os

import pytest

os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tablewright.session import local_session
    session = local_session(cores=8, shuffle_partitions=8, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
