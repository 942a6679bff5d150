import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from hubbub.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="hubbub-tests-")
    session = local_session(
        "8",
        shuffle_partitions=4,
        **{
            "spark.sql.warehouse.dir": f"{work}/warehouse",
            "spark.checkpoint.dir": f"{work}/checkpoints",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
