"""The driver contract: smoke entry, registry shape, and every registered
query against its DuckDB oracle on the small fixture."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"
NO_ORACLE: set = set()
SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "BooleanType": "BOOLEAN"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "senal_promedio" in df.columns and "operador_nombre" in df.columns


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E.QUERIES) - set(o) == NO_ORACLE
    assert len(q) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert canon(srows, sdf.columns) == canon(drows, dcols)
    # column types agree too
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
              for f in sdf.schema.fields}
    assert stypes == dtypes
