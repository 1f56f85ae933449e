"""Every registered query against its DuckDB oracle on sf0.001: same column
names, same rows (order-insensitive, floats exact)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.library_queries()) == set(E.library_oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id_artiste", "nom", "nb_fan", "score_popularite_moyen", "nb_titres_classes"]
    assert len(df.collect()) == 9


@pytest.mark.parametrize("key", sorted(E.library_queries()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _rows(sdf.columns, srows, None) == _rows(ocols, orows, None)
