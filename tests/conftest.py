import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from grimlake.session import build_session
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()
