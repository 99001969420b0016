import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerweave.session import local_session, ship_package
    s = local_session("4", 8, app="ledgerweave-tests")
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck001():
    import oracle_harness as H
    return H.duck(SF001)


@pytest.fixture(scope="session")
def duck0001():
    import oracle_harness as H
    return H.duck(SF0001)
