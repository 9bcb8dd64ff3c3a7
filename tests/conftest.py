import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loanscore.session import local_session

    s = local_session("*", shuffle_partitions=8, app="loanscore-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def keyed_smoke(spark):
    from loanscore.plans.queries import keyed

    return keyed(spark, SMOKE)
