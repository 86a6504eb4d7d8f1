"""The registered queries: their names and their columns over the whole of their table."""

import pytest

from __spark_entry__ import queries

COLUMNS = {
    "op1_secret_entropy": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_token_files": "doc_id start n_tokens ids_crc32",
    "op3_toxicity_crf": "doc_id held_out score predicted",
    "op4_repeated_bytes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_quality_ratio": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_mixing_entropy": "doc_id size source_size target taken",
    "op7_repeated_words": "doc_id n_words n_removed kept_sha256",
    "op8_near_tensored": "doc_id n_shingles component_id kept",
    "op9_contamination_seeds": "doc_id item_id",
    "op10_language_ppm": "doc_id held_out lang_pred score",
    "op11_lexical_signatures": "item_id rank doc_id score",
    "op12_deleted_interpolation": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op13_merkle_intervals": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


def test_one_query_per_operator():
    assert sorted(q for q in queries() if q.startswith("op")) == sorted(COLUMNS)
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - {"op9_contamination_seeds", "op11_lexical_signatures"}))
def test_columns_and_rows(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    expected = COLUMNS[name].split()
    assert df.columns[: len(expected)] == expected
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert df.count() == docs.count()
    assert df.join(docs, "doc_id", "left_anti").count() == 0


@pytest.mark.parametrize("name", ["op1_secret_entropy", "op6_mixing_entropy"])
def test_native_plans_hold_no_python(spark, sf_dir, name):
    text = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoop"))
