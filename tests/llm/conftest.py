import pytest

from tidewell.llm.base import share_code


@pytest.fixture(autouse=True)
def shared(spark):
    share_code(spark)
