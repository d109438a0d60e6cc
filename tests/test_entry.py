import duckdb

import __spark_entry__ as entry
from lamina import catalog

TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "clean_text" in df.columns


def test_every_query_has_a_callable_and_oracles_name_queries():
    q = entry.queries()
    assert all(callable(f) for f in q.values()) and set(entry.oracle_sql()) <= set(q)


def test_import_does_not_need_the_optional_parts(monkeypatch):
    monkeypatch.setattr(entry, "_optional", lambda name: None)
    assert set(entry.queries()) == set(catalog.QUERIES) and set(entry.oracle_sql()) == set(catalog.ORACLES)


def test_some_queries_equal_their_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ("artifact_clean_text", "nav_row", "page_stats", "topic_overlap", "token_batches", "knn_cosine"):
        rel = con.sql(catalog.ORACLES[name])
        df = entry.queries()[name](spark, sf)
        assert sorted(rel.columns) == sorted(df.columns)
        assert sorted(map(str, (tuple(r) for r in df.select(*rel.columns).collect()))) == sorted(map(str, rel.fetchall())), name
