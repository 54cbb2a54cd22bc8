import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelrank.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples for comparison."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
