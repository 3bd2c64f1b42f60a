"""The registered queries against their SQL, and what each must return."""

import __spark_entry__
import harness
import pytest
from millrace.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_chat_formatting": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op2_secret_scan": ["doc_id"],
    "op3_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op4_source_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_embedding_near_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op6_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_benchmark_decontamination": ["doc_id", "item_id"],
    "op9_simhash_near_dedup": ["doc_id", "fingerprint", "component_id"],
    "op10_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op12_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_ranked_search": ["item_id", "rank", "doc_id", "score"],
}
LONGS = {"doc_id", "n_a", "n_b", "n_groups", "n_best", "count_sum", "conv_id", "page_id", "vec_id", "n_turns", "loss_chars", "formatted_chars", "n_chars", "size", "source_size", "taken", "n_links", "component_id", "n_words", "n_removed"}


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows(spark, sf_dir, name):
    assert harness.compare(QUERIES[name](spark, sf_dir), harness.connect(sf_dir), ORACLES[name]) is None


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, sf_dir, name):
    types = dict(QUERIES[name](spark, sf_dir).dtypes)
    assert set(COLUMNS[name]) <= set(types)
    assert all(types[c] == "bigint" for c in COLUMNS[name] if c in LONGS)


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
