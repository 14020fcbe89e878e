import pytest

import __spark_entry__ as entry
import compare


@pytest.mark.parametrize("name", ["op1_source_mixing", "op3_quality_rules", "op4_decontamination", "op12_periodic_runs", "op13_phrase_collocation"])
def test_query_equals_its_check(spark, sf, name):
    ok, _, _, note = compare.compare(spark, compare.connect(sf), name, sf)
    assert ok, note


@pytest.mark.parametrize("name,columns", [
    ("op5_language_id", "doc_id held_out lang_pred score"),
    ("op6_simhash_dedup", "doc_id fingerprint component_id"),
    ("op8_url_filter", "page_id host path rule verdict"),
    ("op9_toxicity", "doc_id held_out score predicted"),
    ("op11_html_extraction", "page_id url text n_chars"),
    ("op10_rnn_scoring", "doc_id held_out n_tokens n_known train_tokens base_score score"),
])
def test_columns_of_the_contract(spark, sf, name, columns):
    frame = entry.queries()[name](spark, sf)
    assert frame.columns[: len(columns.split())] == columns.split()
    table = "pages" if name.startswith(("op8", "op11")) else "documents"
    assert frame.count() == spark.read.parquet(f"{sf}/{table}.parquet").count()
