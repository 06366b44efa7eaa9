"""What a task reads is bounded, whatever the session's own settings say."""

import pytest

from tidewater.session import TASK_BOUNDS, configure, spread
from tidewater.sources.testdata import TestData
from tests.conftest import SMALL


@pytest.fixture
def kept(spark):
    keys = [*TASK_BOUNDS, "spark.sql.shuffle.partitions"]
    before = {k: spark.conf.get(k) for k in keys}
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("key, most", TASK_BOUNDS.items())
def test_a_task_reads_a_bounded_part(kept, key, most):
    for given in ("128m", "64MB", "1g", str(most * 3)):
        kept.conf.set(key, given)
        configure(kept)
        assert int(kept.conf.get(key)) == most
    kept.conf.set(key, "1m")  # never raised
    configure(kept)
    assert kept.conf.get(key) == "1m"


def test_partitions_follow_the_input(kept):
    key, unit = "spark.sql.shuffle.partitions", TASK_BOUNDS["spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    kept.conf.set(key, "12")
    spread(kept, 5 * unit)
    assert kept.conf.get(key) == "12"
    spread(kept, 400 * unit + 1)
    assert kept.conf.get(key) == "401"
    assert 0 < TestData(kept, SMALL).n_bytes() < unit
