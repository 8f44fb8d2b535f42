import dataclasses
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.queries import models  # noqa: E402
from shelfcast.session import build_session  # noqa: E402

# The tests fit smaller models than the registered queries.
models.FOREST_TREES, models.POOLED_TREES = 60, 20
models.GLOBAL = dataclasses.replace(models.GLOBAL, steps=6)
models.PER_STORE = dataclasses.replace(models.PER_STORE, steps=6)
models.TWEEDIE = dataclasses.replace(models.TWEEDIE, steps=3, depth=5)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
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
def mart(spark, sf_dir):
    from shelfcast.sources.retail import open_mart

    return open_mart(spark, sf_dir)
