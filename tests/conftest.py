import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, shuffle_partitions=8, app="quire-tests")
    yield s


@pytest.fixture()
def tmpdir_path(tmp_path):
    return str(tmp_path)
