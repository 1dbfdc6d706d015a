import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from learnstream.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="learnstream-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def lines_df(spark, lines):
    return spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "pos bigint, value string")
