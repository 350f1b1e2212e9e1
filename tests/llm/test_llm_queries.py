"""The registered queries: SQL where there is some, the contract's columns, and the pipeline's decisions."""

import pytest
from compare import differences, duck
from conftest import SMALL

import __spark_entry__ as contract
import corpus_pipeline
from tracklens.llm import decontaminate, linededup, simhash
from tracklens.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_nearest": "query_id rank vec_id score",
    "op2_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op3_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7_licences": "doc_id families",
    "op8_decontamination": "doc_id item_id",
    "op9_html_extraction": "page_id url text n_chars",
    "op10_toxicity": "doc_id held_out score predicted",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_token_files": "doc_id start n_tokens ids_crc32",
}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES) and {*COLUMNS, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - {"op7_licences"}))
def test_columns(spark, name):
    assert set(COLUMNS[name].split()) <= set(QUERIES[name](spark, SMALL).columns)


def test_pipeline_stages(spark):
    """Each stage against its operator's own result on what the stage before kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SMALL)
        assert made.columns == docs.columns
        rows = spark.createDataFrame(made.collect(), docs.schema)
        kept[name] = (docs, rows)
        docs = rows
    before, after = kept["line_dedup"]
    lines = {r.doc_id: r.text for r in linededup.drop_repeated_lines(before).collect()}
    assert {r.doc_id: r.text for r in after.collect()} == lines
    before, after = kept["simhash"]
    groups = {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert {r.doc_id for r in after.collect()} == groups
    before, after = kept["decontamination"]
    hit = {r.doc_id for r in decontaminate.contained_items(before, benchmark).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - hit
    packed = corpus_pipeline.pack(spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
