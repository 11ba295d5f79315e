"""Corpus queries with checking SQL, over the smallest copy of the given tables."""

import duckdb
import pytest

from ampliframe.llm import queries
from helpers import SF_DIR


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    answer = con.sql(queries.ORACLES[name])
    assert sorted(answer.columns) == sorted(df.columns)
    picked = ", ".join(df.columns)
    want = con.sql(f"select {picked} from ({queries.ORACLES[name]}) as q").fetchall()
    assert sorted([tuple(r) for r in df.collect()], key=repr) == sorted(want, key=repr)
