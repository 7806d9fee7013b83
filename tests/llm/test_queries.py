"""The registered queries of the package against their SQL, and the pipeline against its operators."""

import duckdb
import pytest
from frames import *  # noqa: F403

import corpus_pipeline
from tallyloom.llm import decontaminate, line_crf, line_dedup, ngram_join, queries as llm_queries, sql
from tallyloom.llm.queries import tokenizer

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    frame = llm_queries.queries()[name](spark, SMALL)
    relation = con.sql(sql.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    expected = sorted(str(tuple(r[relation.columns.index(c)] for c in columns)) for r in relation.fetchall())
    assert sorted(str(tuple(r[c] for c in columns)) for r in frame.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(llm_queries.QUERIES) - set(sql.oracle_sql()) - {"op13_spelling_variants"}))
def test_query_returns_all_rows(spark, name):
    frame = llm_queries.queries()[name](spark, SMALL)
    table = "pages" if name in ("op4_warc", "op5_html_text") else "documents"
    n = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    assert 0 < frame.count() < n if name == "op6_decontamination" else frame.count() == n


def test_pipeline_equals_its_stages_one_by_one(spark):
    import hashlib

    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = line_crf.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {i for i, s in zip(rows, model.scores([r["text"] or "" for r in rows.values()]), strict=True) if s >= 0.3}
    kept = docs.where(docs.doc_id.isin(list(good)))
    texts = {r["doc_id"]: r["kept_text"] for r in line_dedup.dedup_lines(kept).collect()}
    lines = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    first = {r["doc_id"] for r in ngram_join.similar_documents(lines).where("doc_id = component_id").collect()}
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    block = decontaminate.Block.of([b["item_id"] for b in bench], [decontaminate.normalized(b["text"]) for b in bench])
    clean = {i for i in first if not list(decontaminate._matches(block, [decontaminate.normalized(texts[i])]))}
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    expected = {}
    for i in clean:
        ids = library.encode(texts[i], add_special_tokens=False).ids
        expected[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    result = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in result.collect()} == expected
    assert 0 < len(expected) < len(rows)


def test_stages_handle_odd_rows(spark, odd_docs, no_docs):
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, odd_docs, SMALL)
        assert out.count() <= odd_docs.count() and function(spark, no_docs, SMALL).count() == 0
        if name != "encode":
            assert out.columns == odd_docs.columns


def test_benchmark_passages_leave_without_an_id_too(spark, make_docs):
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    leak = f"before {passage} after"
    docs = make_docs(["clean", leak], [(None, leak, "en", "s", 1), (None, "clean too", None, None, None), (0, leak, "en", "s", 1)])
    kept = corpus_pipeline.drop_benchmark(spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == [(0, "clean"), (None, "clean too")]
