"""Every registered query against its oracle SQL in DuckDB on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def canonical(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if name not in ORACLES:
        assert got
        return
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert canonical(got) == canonical([[r[i] for i in order] for r in cursor.fetchall()])


@pytest.mark.parametrize("rows", [200, 40])
def test_stratified_pick_takes_documents_outside_the_bins_last(spark, tmp_path, rows):
    con = duckdb.connect()
    con.execute(f"""CREATE TABLE documents AS SELECT doc_id, CASE WHEN doc_id % 31 = 7 THEN NULL WHEN doc_id % 10 = 2 THEN '' ELSE text END AS text, lang, source,
        CASE WHEN doc_id % 31 = 7 THEN NULL WHEN doc_id % 10 = 2 THEN 0 WHEN doc_id % 10 = 5 THEN n_chars + 200000 ELSE n_chars END AS n_chars
        FROM '{FOLDER}/documents.parquet' WHERE doc_id < {rows}""")
    con.execute(f"COPY documents TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    got = QUERIES["stratified_pick"](spark, str(tmp_path)).select("record_id", "length_bin", "doc_id", "n_chars").collect()
    want = con.execute(f"SELECT record_id, length_bin, doc_id, n_chars FROM ({ORACLES['stratified_pick']})").fetchall()
    assert canonical(got) == canonical(want) and any(r["length_bin"] is None for r in got)


def test_best_and_latest_epoch_passes_over_values_that_are_missing(spark, tmp_path):
    con = duckdb.connect()
    rows = [(1, 1, 3.0), (1, 2, None), (1, 3, 2.0), (1, 4, None), (2, 5, None), (2, 6, None), (3, 7, float("nan")), (3, 8, None),
            (4, 9, float("inf")), (4, 10, float("nan")), (4, None, -1.0), (5, 11, float("-inf")), (5, 12, 0.5), (None, 13, 4.0), (None, 14, None)]
    con.execute("CREATE TABLE events (user_id BIGINT, event_id BIGINT, value DOUBLE)")
    con.executemany("INSERT INTO events VALUES (?, ?, ?)", rows)
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    columns = "user_id, best_epoch, best_loss, latest_epoch, latest_loss"
    got = QUERIES["best_and_latest_epoch"](spark, str(tmp_path)).select(*columns.split(", ")).collect()
    assert canonical(got) == canonical(con.execute(f"SELECT {columns} FROM ({ORACLES['best_and_latest_epoch']})").fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["split", "n_rows", "n_clusters", "content_leaks", "cluster_leaks"]
