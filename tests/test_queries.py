"""Every registered query against its SQL twin, on whole tables."""

import __spark_entry__ as entry
import pytest
from topicframe.catalogue.queries import REGISTRY

from .compare import connect, differences

SF_DIR = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert differences(df, duck, entry.oracle_sql()[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "digest" in df.columns


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql())
