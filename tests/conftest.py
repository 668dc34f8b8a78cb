import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quantis.session import local_session

    import tempfile

    s = local_session(4, shuffle_partitions=8, app="quantis-tests", warehouse=tempfile.mkdtemp(prefix="quantis-wh-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (selected columns), order preserved."""
    d = df.select(*cols) if cols else df
    return [tuple(r) for r in d.collect()]
