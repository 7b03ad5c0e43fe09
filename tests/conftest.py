import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from reelmeter.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.path.join(ROOT, "tests") + os.pathsep + os.environ.get("PYTHONPATH", "")
    session = get_spark("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
