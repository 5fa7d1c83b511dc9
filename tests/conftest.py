import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from quillmart.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()

