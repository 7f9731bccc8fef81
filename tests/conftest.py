import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shortfall.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=4, memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def rows():
    """Rows of a frame as dicts keyed by some of its columns."""

    def collect(df, *keys):
        out = {}
        for row in df.collect():
            key = tuple(row[k] for k in keys)
            out[key[0] if len(key) == 1 else key] = row.asDict()
        return out

    return collect
