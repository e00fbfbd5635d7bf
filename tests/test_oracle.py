"""Every registered query against its SQL."""

import pytest

from tablewright.plans import catalogue
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, con, name):
    assert oracle.difference(spark, con, SF, name) is None


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 130
