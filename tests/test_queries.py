"""Every registered query of the document operators against its SQL, run by DuckDB on the same tables."""

import glob
import math
import os

import duckdb
import pytest

from docloom.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def ordered(rows, columns):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    c = duck.execute(ORACLE[name])
    columns = [x[0] for x in c.description]
    assert sorted(got.columns) == sorted(columns)
    assert ordered(got.collect(), got.columns) == ordered(c.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["doc_id", "filename", "chunk_idx", "n_tokens", "page_content", "h1", "h2", "h3", "h4"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
