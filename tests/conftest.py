import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fleetpulse.session import get_spark

    s = get_spark("local[8]", app="fleetpulse-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def bucket_minutes(spark):
    """Temporarily narrow the time buckets of the moving average."""
    from fleetpulse.session import BUCKET_SECONDS_KEY

    def set_(n):
        spark.conf.set(BUCKET_SECONDS_KEY, str(60 * n))

    yield set_
    spark.conf.unset(BUCKET_SECONDS_KEY)


@pytest.fixture
def no_broadcast(spark):
    """No side passes the size check."""
    from fleetpulse.session import BROADCAST_BYTES_KEY

    spark.conf.set(BROADCAST_BYTES_KEY, "0")
    yield
    spark.conf.unset(BROADCAST_BYTES_KEY)
