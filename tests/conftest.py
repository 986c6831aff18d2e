import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import checkpoint_dir, local_session

    s = local_session("ledgerlens-tests", cores="*", shuffle_partitions=8)
    checkpoint_dir(s, local_fallback=True)
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="ledgerlens-test-")
