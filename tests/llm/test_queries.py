"""The registered queries on the smallest tables against their SQL."""

import duckdb
import pytest

from martlet.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, same_rows, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in rel.description]
    same_rows(queries.queries()[name](spark, SF), [dict(zip(columns, r, strict=True)) for r in rel.fetchall()])


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
