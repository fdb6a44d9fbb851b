import pytest

from driftline.llm.common import ready


@pytest.fixture(scope="session")
def corpus(spark):
    return ready(spark)
