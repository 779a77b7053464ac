import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordertrail.session import get_session  # noqa: E402

FOLDER = "/root/testdata/sf{}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER.format(os.environ.get("TEST_SF", "0.01"))


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)
