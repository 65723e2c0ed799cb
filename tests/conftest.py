import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=2)
    yield s


def files_df(spark, items):
    """items: list of (path, content) -> files(path, content)."""
    return spark.createDataFrame(items, "path string, content string")


def kb_df(spark, rows):
    return spark.createDataFrame(rows, "obj_id long, type string, name string, fullname string, annotations array<string>")
