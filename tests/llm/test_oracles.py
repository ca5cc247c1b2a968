import duckdb
import pytest

from planar.llm import queries as q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = q.queries()[name](spark, SF)
    res = con.execute(q.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    rows = sorted((tuple(r[c] for c in sorted(cols)) for r in df.collect()), key=repr)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    assert rows == sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=repr)
    assert rows


def test_a_query_for_each_operator():
    names = set(q.queries())
    assert len(names) == 13 and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
