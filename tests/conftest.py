"""One local Spark session for the whole test run."""

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from erpweave.session import local_session

    session = local_session(cores=8, shuffle_partitions=8, app_name="erpweave-tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="erpweave-tests-"))
    yield session
    session.stop()


def rows(df, *columns):
    """Collected rows as sorted tuples (optionally of some columns only)."""
    if columns:
        df = df.select(*columns)
    return sorted((tuple(r) for r in df.collect()), key=repr)
