"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES = {name: entry.queries()[name] for name in entry.checks.CHECKS}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir).toArrow()
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'").fetchall()
        theirs = db.sql(ORACLE[name]).to_arrow_table()
        assert sorted(ours.column_names) == sorted(theirs.column_names)
        assert ours.num_rows == theirs.num_rows > 0
        columns = ", ".join(f'"{c}"' for c in sorted(ours.column_names))
        db.register("ours", ours)
        db.register("theirs", theirs)
        for a, b in (("ours", "theirs"), ("theirs", "ours")):
            differ = f"SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b}"
            assert db.execute(f"SELECT count(*) FROM ({differ})").fetchall() == [(0,)]
