import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lamina.llm import queries, simhash, tokens
from lamina.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_query_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "mixing", "token_output"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{FOLDER}/documents.parquet')")
    df = queries.QUERIES[name](spark, FOLDER)
    relation = con.sql(queries.ORACLES[name])
    order = [relation.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=str)


def test_stages_act_on_what_is_left(spark):
    docs, left = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= before
        assert docs.columns == COLUMNS or name == "token_output"
        left.append(len(after))
        if name == "simhash_near_dedup":  # nothing near is left
            again = simhash.near_duplicates(docs, 5)
            assert again.select("component").distinct().count() == len(after)
        if name == "mixing":
            mixed = docs
    assert left[0] > left[1] > left[2] == left[3] == left[4] > 0
    # the tokens stand in the order of the mixed files
    rows = [r["doc_id"] for r in mixed.selectExpr("doc_id", "_metadata.file_name AS f", "_metadata.row_index AS i").orderBy("f", "i").collect()]
    assert [r["doc_id"] for r in docs.orderBy("start").collect()] == rows
    whole = tokens.encoder(tokens.tokenizer_path()).whole
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert all(r["n_tokens"] == len(whole.encode(texts[r["doc_id"]], add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert corpus_pipeline.run(spark, FOLDER).orderBy("start").collect() == docs.orderBy("start").collect()
