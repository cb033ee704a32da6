import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidemark.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=8, app="tidemark-tests")
    yield session
    session.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="tidemark-test-")
