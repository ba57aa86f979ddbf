import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from tallymill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, memory="8g", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *names):
        return sorted((tuple(r) for r in df.select(*(names or df.columns)).collect()), key=repr)

    return collect
