import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from postline.session import build_session

    return build_session("postline-tests", partitions=4)


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one column expression."""

    def get(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return get


def pytest_collection_modifyitems(items):
    """The long comparison of all queries runs last."""
    items.sort(key=lambda i: i.module.__name__ == "test_queries")
