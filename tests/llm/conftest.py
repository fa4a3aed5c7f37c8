import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from sheetloom.llm.shipping import ship

    ship(spark)
