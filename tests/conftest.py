import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trend_engine.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app_name="trend-engine-tests")
    yield s
    s.stop()


_FRAMES = {}


@pytest.fixture(scope="session")
def result(spark):
    """The DataFrame of a registered query over the smallest tables, made once for all tests (the
    streams and writes behind it are what takes time)."""
    from trend_engine.plans.registry import QUERIES

    def frame(name):
        if name not in _FRAMES:
            _FRAMES[name] = QUERIES[name](spark, SF_SMALL)
        return _FRAMES[name]

    return frame
