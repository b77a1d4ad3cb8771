import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sitewise.session import get_session, shared_dir
    s = get_session("local[4]", 4, app_name="sitewise-tests")
    shared_dir(s)
    yield s
    s.stop()
