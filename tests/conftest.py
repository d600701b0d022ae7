import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        # Tests find their input in plans by its path, which Spark cuts after 100 characters by default.
        "spark.sql.maxMetadataStringLength": "2000",
    })
    session.sparkContext.setLogLevel("OFF")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
