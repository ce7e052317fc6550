import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cartwheel.session import local_session
    s = local_session(cores=4, shuffle_partitions=8, app="cartwheel-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    from cartwheel.plans.verify import duck_connect
    return duck_connect(SMALL)
