import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakepipe.session import build_session
    s = build_session("local[4]", app="lakepipe-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of the given columns (or all)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
