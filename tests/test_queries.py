import pytest

from cantolith.plans import registry
from tests.harness import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, con, name):
    compare(registry.QUERIES[name](spark, SF), con, registry.ORACLE[name])


KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_types_equal_sql(spark, con, name):
    ours = {f.name: KINDS[f.dataType.simpleString()] for f in registry.QUERIES[name](spark, SF).schema}
    assert ours == {r[0]: str(r[1]) for r in con.execute("DESCRIBE " + registry.ORACLE[name]).fetchall()}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
