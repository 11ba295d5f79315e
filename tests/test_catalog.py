"""Every registered query against its SQL, over the smallest copy of the given tables."""

import math
import os

import pytest

from ampliframe.plans import catalog
from ampliframe.plans.fixtures import TABLES, VIEWS, view, with_views

SF_DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")

# Queries without checking SQL, and where their results are tested instead.
UNCHECKED = {
    "document_compare": "test_alignment",
    "document_orientation": "test_alignment",
    "read_stack": "test_orient",
    "primer_panel_best": "test_primer_panel",
}


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def plain(rows):
    def text(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
        return repr(v)

    return sorted(tuple(text(v) for v in r) for r in rows)


def test_every_query_is_checked_or_listed():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == set(UNCHECKED)
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, engine, name):
    df = catalog.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    if name not in catalog.ORACLES:
        assert got
        return
    answer = engine.sql(catalog.ORACLES[name])
    assert sorted(answer.columns) == columns
    at = [answer.columns.index(c) for c in columns]
    assert plain(got) == plain([tuple(r[i] for i in at) for r in answer.fetchall()])


@pytest.mark.parametrize("name", ["fx_seq", "fx_cons2", "fx_amplicon", "fx_layout_files"])
def test_views_agree(spark, engine, name):
    assert name in VIEWS
    df = view(spark, SF_DIR, name)
    columns = sorted(df.columns)
    picked = ", ".join(f'"{c}"' for c in columns)
    answer = engine.sql(with_views(f"select {picked} from {name}")).fetchall()
    assert plain([tuple(r[c] for c in columns) for r in df.collect()]) == plain(answer)


@pytest.mark.parametrize("name", ["stored_reads", "stored_read_numbers", "selected_reads", "gzip_block_totals"])
def test_stored_reads_where_spark_pushes_no_filters(spark, engine, name):
    conf = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        test_query(spark, engine, name)
    finally:
        spark.conf.set(conf, before)


@pytest.fixture(scope="module")
def odd_documents(tmp_path_factory):
    """The smallest tables with more documents, and an engine over them."""
    folder = tmp_path_factory.mktemp("odd")
    rows = [("E" * n, "web") for n in range(600, 900)]  # all of one quality, the least one asked for
    rows += [("hello world " * 60, s) for s in ODD_SOURCES] + [("", s) for s in ODD_SOURCES] + [(None, None)]
    con = duckdb.connect()
    con.execute("create table odd (i bigint, text varchar, source varchar)")
    con.executemany("insert into odd values (?, ?, ?)", [(i, *r) for i, r in enumerate(rows)])
    for t in TABLES:
        if t != "documents":
            os.symlink(f"{SF_DIR}/{t}.parquet", folder / f"{t}.parquet")
    more = "select 10000000 + i as doc_id, text, 'en' as lang, source, length(text) as n_chars from odd"
    given = f"select * from '{SF_DIR}/documents.parquet'"
    con.execute(f"copy ({given} union all by name {more}) to '{folder}/documents.parquet'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return str(folder), con


ODD_SOURCES = [
    "none", "", " ", "a/b", "a%2Fb", "a+b", "a b", "a=b/c", "é", "a\\b", "a#b?c", "a\nb", "a:b", "*", "%zz", "..",
    "__HIVE_DEFAULT_PARTITION__", "_x", ".x",
]


@pytest.mark.parametrize("pushed", ["true", "false"])
@pytest.mark.parametrize(
    "name",
    ["selected_reads", "stored_reads", "stored_read_numbers", "gzip_block_totals", "stored_gzip_audit", "stored_listing"],
)
def test_stored_reads_of_odd_documents(spark, odd_documents, monkeypatch, name, pushed):
    folder, engine = odd_documents
    monkeypatch.setitem(globals(), "SF_DIR", folder)
    conf = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, pushed)
    try:
        test_query(spark, engine, name)
    finally:
        spark.conf.set(conf, before)
