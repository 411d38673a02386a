import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from touchline.session import local_session
    # Tests own their checkpoint folder (on a cluster it comes from the conf).
    shared = tempfile.mkdtemp(prefix="tl-test-ckpt-", dir="/tmp")
    s = local_session(4, shuffle_partitions=4, app_name="touchline-tests", extra={"spark.checkpoint.dir": shared})
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="tl-test-", dir="/tmp")
