import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ticket_topics.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
