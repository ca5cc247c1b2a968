import re

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["part", "events", "orders", "embeddings", "lineitem"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "n"]
    assert df.count() > 0


def _own(names):
    """Without the optional training-data queries."""
    return {n for n in names if not re.match(r"op\d+_|pipeline$", n)}


def test_every_query_has_a_callable_and_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert _own(o) == _own(q) and len(_own(q)) >= 52


def test_works_without_the_optional_folder(spark, monkeypatch):
    monkeypatch.setattr(E, "llm", None)
    monkeypatch.setattr(E, "corpus_pipeline", None)
    assert set(E.queries()) == _own(E.queries()) == set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(_own(E.oracle_sql())))
def test_matches_oracle_sf0001(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(rows, df.columns) == _canon(res.fetchall(), ocols)


def test_package_is_shipped_once_per_application(spark):
    from planar.plans import session

    session.ship_package(spark)
    before = set(spark.sparkContext.listFiles) if hasattr(spark.sparkContext, "listFiles") else None
    session.ship_package(spark)  # second call is a no-op
    assert spark.sparkContext.applicationId in session._SHIPPED
    if before is not None:
        assert set(spark.sparkContext.listFiles) == before
    # Python stages import the package on the workers.
    assert E.queries()["convex_hull_part"](spark, SF).count() > 0
