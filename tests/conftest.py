from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from layercake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="layercake-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="layercake-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples, in the given column order."""
    names = cols or tuple(df.columns)
    return [tuple(r[c] for c in names) for r in df.select(*names).collect()]
