import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from loomwell.session import get_session, release_scratch  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "loomwell-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def rows():
    """Sorted tuples of a frame, NULL-safe."""
    return lambda df, *columns: sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
