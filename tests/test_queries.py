"""Every query against its SQL on the same tables, value by value."""

import duckdb
import pytest

import __spark_entry__ as entry
from sessile import queries as base

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(base.queries()))
def test_query(name, spark, sf, duck):
    df = base.queries()[name](spark, sf)
    rows, columns = df.collect(), sorted(df.columns)
    if name not in base.oracle_sql():
        assert rows
        return
    rel = duck.sql(base.oracle_sql()[name])
    expected, names = rel.fetchall(), rel.columns
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(names, map(str, rel.types), strict=True))
    got = sorted(repr([r[c] for c in columns]) for r in rows)
    assert got == sorted(repr([r[names.index(c)] for c in columns]) for r in expected)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["run_id", "frame_no", "endpoint", "beginning"]


def test_registries_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_all_imports_without_the_llm_folder():
    import subprocess
    import sys

    code = "import sys; sys.modules['sessile.llm'] = None; sys.modules['corpus_pipeline'] = None\nimport __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op')])"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.__file__.rsplit("/", 1)[0])
    assert out.stdout.split(" ", 1) == [str(len(base.queries())), "[]\n"], out.stderr
