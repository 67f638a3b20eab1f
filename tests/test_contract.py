"""Registered queries against DuckDB on the smallest given tables."""

from pathlib import Path

import pytest
from panel_rows import plan_of

import __spark_entry__ as contract
from hourpanel.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")
COMPARED = [
    "scan_union_by_name", "calendar_csv", "flatten_columnar_json", "day_range_replace",
    "key_replace", "localize_wall_clock", "expected_hours", "stg_sensors", "nearest_block",
    "terms_by_day", "location_rank", "check_gaps_own_range", "check_churn", "check_all",
    "feature_matrix", "rolling_origin_baseline", "export_wide", "train_summary",
]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns, rows):
    def shown(value):
        if value is None or value != value:
            return ""
        return repr(float(value)) if isinstance(value, float) else str(value)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(row[i]) for i in order) for row in rows)


def test_every_statement_has_a_query_and_parses(duck):
    queries, statements = contract.queries(), contract.oracle_sql()
    assert set(statements) <= set(queries)
    own = {name for name in queries if name in QUERIES}
    assert own == {name for name in statements if name in own}
    for name, sql in statements.items():
        assert duck.sql(sql).columns, name


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_duckdb(spark, duck, name):
    df = contract.queries()[name](spark, str(DATA))
    expected = duck.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert canonical(df.columns, df.collect()) == canonical(expected.columns, expected.fetchall())


def test_entry_runs(spark):
    assert not contract.entry(spark).isEmpty()
