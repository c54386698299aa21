import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from filanda.runtime import build_session, ship

    s = build_session("tests", cores=4, partitions=4, memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


def rows(df):
    return sorted(tuple(r) for r in df.collect())
