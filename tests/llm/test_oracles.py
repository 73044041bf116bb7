import pytest

from sievekit.llm import registry
from tests.compare import connection, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_query_covers_its_table(spark, name):
    rows = registry.queries()[name](spark, SF)
    assert rows.select("doc_id").distinct().count() == rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
