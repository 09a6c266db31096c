import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from quern.session import local_session

    session = local_session("*", 8, app_name="quern-tests")
    yield session
    session.stop()


def rows(df, order=None):
    """Collected rows as tuples, sorted (or in ``order`` if the frame is ordered)."""
    out = [tuple(r) for r in df.collect()]
    return out if order == "keep" else sorted(out, key=lambda r: tuple((x is None, x) for x in r))
