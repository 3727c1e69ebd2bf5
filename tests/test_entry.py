"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_mod


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["user", "item", "rating", "prediction"]
    assert df.count() == 1062


def test_every_query_has_an_oracle():
    from kinship.plans.catalog import QUERIES

    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
