import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from likeness.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

# FIXTURES.md §2: the 4-user x 4-item micro fixture with hand-computed answers.
MICRO = [
    ("u1", "b1", 5.0), ("u1", "b2", 3.0), ("u1", "b3", 4.0),
    ("u2", "b1", 3.0), ("u2", "b2", 1.0), ("u2", "b3", 2.0), ("u2", "b4", 3.0),
    ("u3", "b1", 4.0), ("u3", "b2", 3.0), ("u3", "b4", 5.0),
    ("u4", "b3", 1.0), ("u4", "b4", 2.0),
]
MICRO_TEST = [("u1", "b4"), ("u2", "b4"), ("u4", "b1"), ("u1", "b9"), ("u9", "b1"), ("u9", "b9")]


@pytest.fixture(scope="session")
def spark():
    s = local_session(shuffle_partitions=8, app="likeness-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def micro(spark):
    return spark.createDataFrame(MICRO, "user_id string, item_id string, rating double")


@pytest.fixture(scope="session")
def micro_test(spark):
    return spark.createDataFrame(MICRO_TEST, "user_id string, item_id string")
