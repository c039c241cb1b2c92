import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from quayside.llm.shipping import ship

    ship(spark)
