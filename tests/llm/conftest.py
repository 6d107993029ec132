import pytest

from ontime.session import TEXT_BATCH


@pytest.fixture(autouse=True)
def batch_size_of_its_own(spark):
    """Stages leave the batch size set in the session; the tests share one session and must not see it of each other."""
    yield
    for key in TEXT_BATCH:
        spark.conf.unset(key)
