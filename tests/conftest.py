from __future__ import annotations

import pytest

from duskline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
