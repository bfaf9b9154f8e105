import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from layerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def rows():
    """Collect a frame as a sorted list of tuples."""

    def collect(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in found.collect()), key=lambda row: tuple((v is None, str(v)) for v in row))

    return collect
