import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from equiframe.session import checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    # tests only: a private checkpoint folder when the session names none
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="equiframe-ckpt-", dir="/tmp"))
    yield s
