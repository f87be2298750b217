import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from courierlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="courierlake-test-")
    session = build_session(
        "courierlake-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
            "spark.checkpoint.dir": f"{folder}/shared",
            # Far from UTC, with a daylight-saving change: no result may depend on it.
            "spark.sql.session.timeZone": "America/New_York",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="courierlake-test-")


@pytest.fixture
def database(spark):
    name = "test_" + Path(tempfile.mkdtemp()).name.lower().replace("-", "_")
    spark.sql(f"CREATE DATABASE {name}")
    return name
