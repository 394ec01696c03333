import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillgrid.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
