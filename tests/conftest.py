import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from geoindicators.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, app="geoindicators-tests")
    yield s


@pytest.fixture
def keys():
    from geoindicators.keys import Keys

    return Keys()


def rows(df, *cols, order=None):
    """Collect as list of tuples (sorted for order-insensitive checks)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t)) if order is None else out
