import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgersift.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "8", driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def txn(spark, folder):
    from ledgersift.sources.lineitem_view import txn_view
    return txn_view(spark, folder).cache()
