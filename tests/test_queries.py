"""Every core query beside its SQL on the smallest tables."""

import pytest

from compare import compare, views
from lamina.plans import registry

SF = "/root/testdata/sf0.001"
SQL = registry.sql()


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF, registry.queries()[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_comparison_sees_a_difference(spark, con):
    wrong = SQL["worker_plan"].replace("/ 3", "/ 2")
    assert compare(spark, con, "worker_plan", SF, registry.queries()["worker_plan"], wrong) != ""
