import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crosswalk.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def data_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""
    def collect(df, *columns):
        out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
