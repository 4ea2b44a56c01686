import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from venuelens.session import checkpoint_dir, get_session
    s = get_session("local[4]", 8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from venuelens.standins import Tables
    return Tables(spark, SF_SMALL)
