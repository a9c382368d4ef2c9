import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from riskloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("riskloom-tests", cores=8, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df, *order):
    """Rows as dictionaries, sorted."""
    keys = order or df.columns
    found = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(found, key=lambda r: [(r[k] is not None, r[k]) for k in keys])
