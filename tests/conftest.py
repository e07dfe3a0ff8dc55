import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from marketlane import scratch, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session.build(8, "tests")
    yield spark
    scratch.clear(spark)
    spark.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture()
def rows():
    """Rows of a frame as sorted tuples, NULLs first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])

    return collect
