import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from jobtide.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("JOBTIDE_SCRATCH", tempfile.mkdtemp(prefix="jobtide-test-"))
    s = get_spark("local[4]", app="jobtide-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="jobtide-t-", dir=os.environ.get("JOBTIDE_SCRATCH", "/tmp"))
