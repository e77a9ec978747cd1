"""Every registered query with SQL gives the SQL's rows on the smallest tables; the others give rows."""

import pytest

from svloom.plans import calls, evidence, finals, registry, softclip, text  # noqa: F401

from .compare import assert_same, connect

#: Rows that the smallest tables have no case of.
MAY_BE_EMPTY = {"exact_match_join", "res_itx"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, sf_dir, con, name):
    expected = con.sql(registry.SQL[name]).df()
    assert len(expected) or name in MAY_BE_EMPTY
    assert_same(registry.QUERIES[name](spark, sf_dir), expected)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_gives_rows(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
