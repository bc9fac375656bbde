import sys

import pytest

import tidemark.plans.catalogue  # noqa: F401
from tidemark import registry

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from tests.helpers import same_rows  # noqa: E402

ORACLES = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    same_rows(spark, registry.queries()[name], ORACLES[name])
