from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loomtext.session import local_session

    s = local_session("tests", 8, **{"spark.driver.memory": "4g"})
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return SMALL
