"""Every registered query against its SQL on the smallest data folder."""

import os

import pytest

from tests import oracle_check as oc

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oc.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oc.entry.queries()))
def test_query(spark, con, name):
    assert oc.compare(spark, con, SF_DIR, name) is None
