"""Every query of the engine against its DuckDB SQL on the small tables."""

import duckdb
import pytest

from strataloom.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def text(v):
    return "" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in cols) for r in df.collect())
    quoted = ", ".join(f'"{c}"' for c in cols)
    want = sorted(tuple(map(text, r)) for r in con.execute(f"SELECT {quoted} FROM ({ORACLE_SQL[name]})").fetchall())
    assert got == want


def test_unpivot_operator_covers_every_dimension(spark, sf):
    whole = {(r["vec_id"], f"d{r['dim']}"): r["value"] for r in QUERIES["unpivot_embeddings"](spark, sf).collect()}
    assert {k for _, k in whole} == {f"d{i}" for i in range(64)}
    assert {(r["vec_id"], r["dim"]): r["value"] for r in QUERIES["unpivot_wide_all"](spark, sf).collect()} == whole


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
