from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from souk.session import get_session

    s = get_session(
        "souk-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="souk-test-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="souk-test-wh-"),
        },
    )
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns if none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
