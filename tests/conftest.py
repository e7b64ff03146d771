import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from catamill.session import local_session

    s = local_session("tests", 4)
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.environment["PYTHONPATH"] = str(ROOT)
    return s


@pytest.fixture(scope="session")
def sf():
    return SF
