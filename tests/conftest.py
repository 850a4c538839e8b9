from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from junctionflow.session import get_spark

    # Tests run with no cluster-provided shared folder, so they set their own.
    s = get_spark(
        "local[4]",
        shuffle_partitions=4,
        app_name="junctionflow-tests",
        conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="jf-test-cp-")},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="jf-test-")


def rows(df, *cols):
    """Sorted plain tuples of the given columns."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
