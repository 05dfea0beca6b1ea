"""The pipeline's stages on the smallest tables, and the queries against SQL."""

import corpus_pipeline
import duckdb
from tripledger.llm.oracles import ORACLES
from tripledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert now <= ids and now, name
        ids = now
        assert docs.columns == columns if i < 4 else set(columns) < set(docs.columns)
    assert docs.where("n_chars <> length(text)").count() == 0


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_queries_match_sql(spark):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    for name, sql in ORACLES.items():
        got = QUERIES[name](spark, SF)
        cols = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want)
