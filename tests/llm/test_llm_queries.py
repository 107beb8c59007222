"""The registered queries: against their SQL on the smallest tables, and the pipeline by its parts."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard_join import brute as linked
from tidemart.llm.queries import QUERIES, word_tokenizer
from tidemart.llm.sql import SQL
from verify import rows_of


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{Path(SF_DIR) / t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(SQL[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, theirs.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL and "license" not in n and "packing" not in n and "bpe" not in n])
def test_query_has_a_row_per_document(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() == duck.execute("SELECT count(*) FROM documents").fetchone()[0]


def test_pipeline_by_brute_force(spark, duck, tmp_path):
    from tests.llm.test_packing import check
    from tidemart.llm.common import table

    docs = table(spark, SF_DIR, "documents")
    columns, kept, held = docs.columns, {}, docs
    for name, stage in corpus_pipeline.STAGES:
        before, out = held, stage(spark, held, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        held = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in held.select("doc_id").collect()}
        rows = [(r.doc_id, r.text) for r in before.collect()]
        if name != "best_fit_packing":
            assert held.columns == columns
        if name == "ngram_jaccard_join":
            assert kept[name] == {d for d, _, c in linked(rows) if d == c}
        if name == "benchmark_decontamination":
            items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
            assert kept[name] == {r[0] for r in contaminated(rows, items) if not r[-1]}
        if name == "best_fit_packing":
            check(rows, held.collect(), 2048)
    # documents that a filter rejects in their own language, or as toxic, are few: clean ones stay
    assert len(kept["language_id"]) >= 190
    toxic = {r[0] for r in duck.execute("SELECT doc_id FROM labels WHERE toxic = 1").fetchall()}
    assert len(kept["toxicity"] & toxic) <= 3
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in whole.select("doc_id").collect()} == kept["best_fit_packing"]
    assert Path(word_tokenizer()).exists()
