import pytest

from sievekit.plans import catalog

from .compare import connection, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    same(catalog.queries()[name](spark, SF), con, catalog.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(catalog.queries().keys() - catalog.oracle_sql().keys()))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_closed_set_pipeline(spark):
    rows = catalog.queries()["closed_set_pipeline"](spark, SF).collect()
    by = {}
    for r in rows:
        by.setdefault(r.label, []).append(r)
    for label, own in by.items():
        assert len(own) == 8 and sorted(r.place for r in own) == list(range(1, 9))
        assert sorted(r.split for r in own) == ["test"] * 2 + ["train"] * 6  # 5.6 rounds to 6
        assert sorted(r.output_name for r in own) == [f"{label}_{i:03d}.jpg" for i in range(1, 9)]
    funnel = {(r.label, r.stage): r.n for r in catalog.flagship(spark, SF).collect()}
    assert all(funnel[5, a] >= funnel[5, b] for a, b in (("candidates", "scored"), ("scored", "pool"), ("pool", "distinct"), ("distinct", "selected")))


def test_open_set_pipeline(spark):
    rows = catalog.queries()["open_set_pipeline"](spark, SF).collect()
    hidden = [r for r in rows if r.split == "hidden"]
    assert len({r.vec_id for r in rows}) == len(rows) and len({r.name for r in hidden}) == len(hidden)
    assert sorted(set(r.label for r in hidden)) == ["0", "1", "other"] and sum(r.label == "other" for r in hidden) == 16
