import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture
def frame(spark):
    """DataFrame from tuples, in two partitions."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(2) if rows else spark.createDataFrame([], schema)
    return make
