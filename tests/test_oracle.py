"""Every registered query against its DuckDB oracle (order-insensitive value hash)."""

import duckdb
import pytest

import __spark_entry__ as E
from eventfeat.plans.catalog import ORACLE, QUERIES
from eventfeat.plans.tables import TABLES
from tools.check_oracle import digest


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, small_dir, name):
    sdf = QUERIES[name](spark, small_dir)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLE[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(scols, srows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, small_dir, name):
    assert QUERIES[name](spark, small_dir).count() > 0


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"event_id", "matched_ts", "view_event_id"} <= set(df.columns)
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_known_values_at_sf001(spark):
    """Values recorded while surveying (FIXTURES.md section C)."""
    from pyspark.sql import functions as F
    d = "/root/testdata/sf0.01"
    r = QUERIES["j7_asof_join"](spark, d).agg(F.count("*"), F.count("matched_ts"), F.sum("view_event_id")).first()
    assert tuple(r) == (1981, 256, 1266518)
    assert QUERIES["j1x_near_date_join"](spark, d).count() == 15140   # fan-out near Dec 24 + Dec 25
    assert QUERIES["v2_rolling_windows"](spark, d).count() == 2       # 24/12/12-month folds on 4 years
