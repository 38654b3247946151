import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sieveline.session import session  # noqa: E402
from sieveline.staging import drop_run  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    started = session(
        "tests",
        "local[8]",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staged")),
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    started.sparkContext.setLogLevel("ERROR")
    yield started
    drop_run(started)
    started.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def plan():
    """Text of the physical plan of a DataFrame."""

    def text(df):
        import contextlib
        import io

        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        return out.getvalue()

    return text
