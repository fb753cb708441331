"""The registered queries: columns, types, rows, and SQL where there is some."""

import __spark_entry__
import pytest
from check import compare, duck
from tillflow.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op2_html_text": "page_id bigint, url string, text string, n_chars bigint",
    "op3_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op4_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op5_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                         "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op6_url_templates": "page_id bigint, host string, path string, rule string, verdict string",
    "op7_licences": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                    "base_labels string, labels string, score double",
    "op8_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
                "spans string",
    "op11_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op12_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
                   "folded_root string, verified boolean",
    "op13_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                      "explained double, identity_error double",
}
TABLE = {"op2_html_text": ("pages", 1), "op6_url_templates": ("pages", 1), "op13_whitening": ("embeddings", 16)}


def test_all_operators_and_the_pipeline_are_registered():
    assert set(QUERIES) == set(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert set(COLUMNS[name].split(", ")) <= {f"{c} {t}" for c, t in found.dtypes}
    table, rows = TABLE.get(name, ("documents", 1))
    assert found.count() == rows * spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), duck(FOLDER), SQL[name]) == ""
