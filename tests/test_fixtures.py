"""The Spark derivations of the case-study tables equal their SQL twins."""

import pytest

from tests.conftest import SMALL
from tidewater.sources.fixtures import Fixtures
from tidewater.sources.oracle_fixtures import CTES, with_tables
from tools.check_oracle import multiset


@pytest.mark.parametrize("name", sorted(CTES))
def test_fixture_matches_sql(spark, duck, name):
    from tidewater.operators import delivery
    fx = Fixtures(spark, SMALL)
    cleaned = {"clean_orders": lambda: delivery.clean_customer_orders(fx.customer_orders),
               "clean_runner": lambda: delivery.clean_runner_orders(fx.runner_orders)}
    if name in cleaned:
        df = cleaned[name]()
    else:
        df = getattr(fx, name) if hasattr(fx, name) else fx.inline(name)
    cur = duck.execute(with_tables([name], f"SELECT * FROM {name}"))
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert multiset([tuple(r) for r in df.collect()], list(df.columns)) == multiset(cur.fetchall(), cols)
