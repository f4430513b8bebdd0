import pytest
from tests.llm.samples import ODD, table


@pytest.fixture(scope="session")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [], "none")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
