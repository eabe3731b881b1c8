import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kohortflow.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", 4)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Sorted tuples, NULL before values."""
    names = columns or df.columns
    out = [tuple(r[c] for c in names) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))
