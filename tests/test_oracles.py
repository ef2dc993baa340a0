"""Every registered query against its SQL on the smallest tables (``python -m checks`` runs the larger ones)."""

import pytest

from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    result = compare(spark, con, sf_dir, name, REGISTRY[name], ORACLES[name])
    assert result["ok"], result["why"]
