import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from storeloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[8]", spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


def rows(df, *order):
    """Rows as dicts, sorted by the given columns."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((r[c] is None, r[c] if r[c] is not None else 0) for c in order)) if order else out


def one(df):
    (row,) = df.collect()
    return row.asDict(recursive=True)
