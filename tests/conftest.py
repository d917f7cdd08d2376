import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pulsekit.session import get_spark
    s = get_spark(master="local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def posts(spark):
    from pulsekit.sources.testdata import posts as load
    return load(spark, SMALL)
