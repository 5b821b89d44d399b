"""Every query with SQL gives the same rows as DuckDB; the others run."""

import math
import unicodedata

import duckdb
import pytest

from tidemill import queries as Q

DATA = "/root/testdata/sf0.001"


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, (bool, str)):
        return str(v)
    try:
        return repr(round(float(v), 9))
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "events", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query(spark, con, name):
    df = Q.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(map(norm, r)) for r in df.select(columns).collect())
    if name not in Q.SQL:
        return
    expected = con.sql(Q.SQL[name])
    assert sorted(expected.columns) == columns
    places = [expected.columns.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in places) for r in expected.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_minimal_clean_normalises(spark, tmp_path):
    texts = [unicodedata.normalize("NFD", x) for x in ("Xe ĐẸP quá Xem thêm ok", "é Å", "plain", "Ế già")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'s' AS source", "'vi' AS lang").write.parquet(path)
    got = {r.doc_id: r.value for r in Q.QUERIES["minimal_clean"](spark, str(tmp_path)).collect()}
    assert got == {0: "xe đẹp quá ok", 1: "é å", 2: "plain", 3: "ế già"}
    own = duckdb.connect()
    own.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert got == dict(own.sql(Q.SQL["minimal_clean"]).fetchall())
