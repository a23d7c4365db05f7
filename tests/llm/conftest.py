import pytest

from jobloom.llm.ship import ship_package


@pytest.fixture(autouse=True, scope="session")
def package(spark):
    ship_package(spark)
