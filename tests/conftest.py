import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallybook.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def source(spark):
    from tallybook.catalog.views import Source

    return Source(spark, SF_DIR)


@pytest.fixture
def frame(spark):
    """``frame("a string, b int", (..), (..))``"""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
