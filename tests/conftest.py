import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lodestar.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="lodestar-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    import uuid

    from lodestar.session import shared_dir
    return shared_dir(spark, f"test-{uuid.uuid4().hex[:10]}")
