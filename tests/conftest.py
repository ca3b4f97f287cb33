import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from verbatim.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", shuffle_partitions=8)
    checkpoint_dir(s, tempfile.mkdtemp(prefix="verbatim-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="verbatim-test-")
