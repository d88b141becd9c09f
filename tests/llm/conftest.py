import pytest

from lakekit.llm.common import ready


@pytest.fixture()
def llm(spark):
    return ready(spark)
