import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gramrank.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[*]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    def make(*values):
        return spark.createDataFrame([(value,) for value in values], "value string")

    return make


@pytest.fixture
def text_file(tmp_path):
    def write(name, *values):
        path = tmp_path / name
        path.write_text("\n".join(values) + "\n", encoding="utf-8")
        return str(path)

    return write
