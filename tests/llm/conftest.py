import pytest


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.001"
