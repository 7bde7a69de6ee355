import duckdb
import pytest

from tidewater.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    got = QUERIES[name](spark, SMALL).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(found.fetchall())
