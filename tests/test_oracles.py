"""Every registered query of the engine against its DuckDB oracle on the smallest tables, those on measured means on larger ones, too."""

import duckdb
import pytest

from shelfloom.plans import registry

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events".split()
ORACLES = registry.oracles()
#: Means of many rows, where a tie in rounding would show only with more groups.
MEANS = ["attach_weather", "clip_weather", "enrich_pipeline_hourly", "incremental_features", "load_weather", "weather_features"]


def views(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def duck():
    return views(SF)


@pytest.fixture(scope="module")
def larger():
    return views(LARGER)


def plain(v):
    return round(float(v), 5) + 0.0 if isinstance(v, float) or type(v).__name__ == "Decimal" else v


def rows(records, columns):
    return sorted(tuple(str(plain(r[i])) for i in columns) for r in records)


def check(df, want):
    assert sorted(df.columns) == sorted(want.columns)
    names = list(want.columns)
    got = rows(df.select(*names).collect(), range(len(names)))
    assert got == rows(want.fetchall(), range(len(names)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    check(registry.queries()[name](spark, SF), duck.sql(ORACLES[name]))


@pytest.mark.parametrize("name", MEANS)
def test_oracle_on_larger_tables(spark, larger, name):
    check(registry.queries()[name](spark, LARGER), larger.sql(ORACLES[name]))
