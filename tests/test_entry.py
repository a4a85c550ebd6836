"""The driver's entry points."""

import __spark_entry__ as entry


def test_flagship_has_rows_and_first_lags_are_filled(spark):
    df = entry.entry(spark)
    assert {"product_id", "week_no", "sales_value_lag_1", "rolling_mean_4"} <= set(df.columns)
    assert df.limit(1).count() == 1


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(q) for q in entry.queries().values())
