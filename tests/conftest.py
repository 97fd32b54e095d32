import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from contrail import get_session
    from contrail.session import checkpoint_dir

    s = get_session(master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="contrail-test-")
