import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from peakwise.session import build_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="peakwise-tests-") as folder:
        session = build_session(
            "tests",
            "local[8]",
            spark__sql__shuffle__partitions="8",
            spark__driver__memory="6g",
            spark__checkpoint__dir=folder,
        )
        session.sparkContext.setLogLevel("ERROR")
        yield session
        release(session)
        session.stop()


@pytest.fixture()
def work(spark):
    from peakwise.session import shared_path

    return shared_path(spark, "test")
