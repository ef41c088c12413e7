import os

import pytest


@pytest.fixture(scope="session")
def sf_small():
    return os.environ.get("TEST_SF_SMALL", "/root/testdata/sf0.001")
