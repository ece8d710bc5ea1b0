import pytest

from cantolith.llm import registry
from tests.harness import compare, connect


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) - {"op4_url_filter"}))
def test_query_equals_sql(spark, name, size):
    d = f"/root/testdata/{size}"
    compare(registry.queries()[name](spark, d), connect(d), registry.oracle_sql()[name])
