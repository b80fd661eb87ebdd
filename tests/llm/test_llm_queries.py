"""Registered queries of the subpackage against their SQL, and their contracts' columns."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from llm_fixtures import ROOT, needs_tables
from tidemark.llm.queries import LLM_ORACLES, LLM_QUERIES

COLUMNS = {
    "op1_quality": ["doc_id", "held_out", "score", "predicted"],
    "op2_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op4_url_filter": ["page_id", "host", "fetched", "suffix", "valid_from", "verdict"],
    "op5_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "holds_repeats"],
    "op6_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op7_decontamination": ["doc_id", "item_id", "item_words", "covered_words", "n_windows", "n_slots", "reparameterised"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op10_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op11_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op12_filter_audit": [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ],
    "op13_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
}
TABLES = {"op4_url_filter": "pages", "op11_embedding_dedup": "embeddings"}


def test_all_are_registered():
    assert set(LLM_QUERIES) == set(COLUMNS)
    assert set(LLM_QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(LLM_ORACLES) <= set(driver.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_gives_its_columns_and_rows(spark, name):
    got = LLM_QUERIES[name](spark, ROOT)
    assert got.columns == COLUMNS[name]
    if name == "op12_filter_audit":
        assert got.count() == 600 * spark.read.parquet(f"{ROOT}/documents.parquet").select("lang").distinct().count()
    elif name == "op13_whitening":
        assert got.count() == 32 * spark.read.parquet(f"{ROOT}/embeddings.parquet").count()
    elif name != "op7_decontamination":
        assert got.count() == spark.read.parquet(f"{ROOT}/{TABLES.get(name, 'documents')}.parquet").count()


@needs_tables
@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for path in Path(ROOT).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = duck.execute(LLM_ORACLES[name])
    names = [d[0] for d in result.description]
    wanted = sorted(repr(tuple(r)) for r in result.fetchall())
    assert sorted(repr(tuple(r)) for r in LLM_QUERIES[name](spark, ROOT).select(*names).collect()) == wanted
