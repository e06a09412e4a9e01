import duckdb
import pytest

import corpus_pipeline
from chromaloom.llm import registry

SF = "/root/testdata/sf0.001"


def views():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_agree_with_sql(spark, name):
    got = registry.QUERIES[name](spark, SF)
    sql = views().sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(sql.columns)
    columns = sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, sql.select(", ".join(columns)).fetchall()))


def test_stages_keep_columns_and_agree_with_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, now = docs.columns, docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == columns, name
        rows = [tuple(r) for r in out.collect()]
        before = {r["doc_id"] for r in now.select("doc_id").collect()}
        assert {r[columns.index("doc_id")] for r in rows} <= before and len(rows) <= counts[-1]
        counts.append(len(rows))
        now = spark.createDataFrame(rows, docs.schema)
    mixed = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert len(mixed) == counts[-1] > 0.5 * counts[0]
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in whole) == sorted((r["doc_id"], r["taken"]) for r in mixed)


def test_stages_on_an_empty_table(spark):
    now = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, now, SF).count() == 0
