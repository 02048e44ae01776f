import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.session import build_session, checkpoint_dir  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Local files: list partition directories on the driver instead of a
    # one-task-per-directory listing job (tiny day partitions in tests).
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.sql.sources.parallelPartitionDiscovery.threshold": "100000"})
    checkpoint_dir(s)  # private folder only because the test session names none
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (order-insensitive compare)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
