import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quillon.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """A table from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def corpus(spark):
    rows = [
        (1, "Ada designed the engine. It fails because the index is bad. The index is a list."),
        (2, "A slice is a segment. Bob met Eve in 1999. Strings have slices!"),
        (3, "The queue holds items.\nA stack is an abstract type: a list with one end."),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.fixture(scope="session")
def asked(spark):
    rows = [
        (1, "Why does the index fail?"),
        (2, "What is a slice?"),
        (3, "When did Bob meet Eve?"),
        (4, "zzz"),
    ]
    return spark.createDataFrame(rows, "q_id bigint, text string")
