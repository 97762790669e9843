"""The registered queries and the pipeline, on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from skytally.llm import ngram_join
from skytally.llm.queries import QUERIES
from skytally.llm.store import saved, table
from tests.llm.helpers import documents


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_query_equals_sql(spark, sf_dir, name):
    query, sql = QUERIES[name]
    ours = query(spark, sf_dir).toArrow()
    with duckdb.connect() as db:
        for t in ("documents", "embeddings", "conversations", "labels", "pages"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'").fetchall()
        theirs = db.sql(sql).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names) and ours.num_rows == theirs.num_rows > 0
    assert sorted(ours.select(columns).to_pylist(), key=repr) == sorted(theirs.select(columns).to_pylist(), key=repr)


def test_pipeline(spark, sf_dir):
    assert len(corpus_pipeline.STAGES) == 5
    docs = first = table(spark, sf_dir, "documents")
    counts = [docs.count()]
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        outs.append(docs)
        counts.append(docs.count())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert dict(docs.dtypes) == dict(first.dtypes)
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    near = ngram_join.op6(outs[0])
    assert outs[1].count() == near.filter("n_shingles > 0").select("component_id").distinct().count() + near.filter("n_shingles = 0").count()
    assert outs[2].filter("text LIKE '%<EMAIL>%'").count() > 0 and outs[2].filter("n_chars <> length(text)").count() == 0
    assert outs[4].filter("NOT lossless").count() == 0 and counts[5] == counts[4]


def test_stages_take_odd_rows(spark, sf_dir):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    assert docs.count() > 0 and docs.filter("NOT lossless").count() == 0
