import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playtrail.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, app="playtrail-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def text_file(tmp_path):
    def write(*lines: str) -> str:
        path = tmp_path / "log.txt"
        path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        return str(path)

    return write


def plan_of(df) -> str:
    """The physical plan as text; with run-time changes if `df` itself was collected before."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, str(v)) for v in row])
