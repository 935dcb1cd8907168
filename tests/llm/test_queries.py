"""The registered corpus queries: their contracts' columns, one row for each document, and their SQL."""

import glob
import os

import duckdb
import pytest

from tests.test_queries import rows
from twinframe.llm import queries as Q

COLUMNS = {
    "op2_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_substring_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op4_chat_format": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op5_near_dedup": "doc_id n_shingles component_id kept",
    "op7_simhash": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op8_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_token_ids": "doc_id start n_tokens ids_crc32",
}


@pytest.mark.parametrize("name", Q.QUERIES)
def test_query(name, spark, sf):
    df = Q.QUERIES[name](spark, sf)
    got = df.toPandas()
    assert set(COLUMNS.get(name, "doc_id").split()) <= set(got.columns)
    key = "conv_id" if name == "op4_chat_format" else "doc_id"
    source = spark.read.parquet(f"{sf}/{'conversations' if key == 'conv_id' else 'documents'}.parquet")
    assert set(got[key]) == {r[0] for r in source.select(key).distinct().collect()} | ({-1} if key == "conv_id" else set())
    assert got[key].is_unique
    if name in Q.ORACLE:
        con = duckdb.connect()
        for f in glob.glob(f"{sf}/*.parquet"):
            con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
        assert rows(got) == rows(con.execute(Q.ORACLE[name]).df())
