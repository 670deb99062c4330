import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from layerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "layerloom-tests",
        cores=os.environ.get("TEST_CPUS", "4"),
        memory="4g",
        config={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("staged"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
