"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entries
import check
from lociframe.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entries.queries())


def test_entry(spark):
    assert entries.entry(spark).count() == 5 * 64


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    text, _, _ = check.compare(spark, con, name, FOLDER)
    assert text.startswith("ok"), text
