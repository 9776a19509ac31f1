"""Registered llm queries against their SQL, and their contract columns."""

import duckdb
import pytest

from eventfeat.llm.queries import ORACLE, QUERIES
from eventfeat.plans.tables import TABLES
from tools.check_oracle import digest

COLUMNS = {
    "op1_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
                          "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op2_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                    "sequence_id": "bigint", "offset": "bigint"},
    "op3_benchmark_decontamination": {"doc_id": "bigint", "item_id": "bigint", "score": "double"},
    "op4_html_extraction": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op5_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op6_suffix_array_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op7_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op8_chat_formatting": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint",
                            "loss_sha256": "string", "formatted_chars": "bigint"},
    "op9_secret_scans": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_url_filters": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op11_periodic_run_detection": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                                    "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
    "op12_conversation_structure_repair": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint",
                                           "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string"},
    "op13_sentencepiece_encoding": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, small_dir, name):
    kinds = dict(QUERIES[name](spark, small_dir).dtypes)
    assert {k: kinds[k] for k in COLUMNS[name]} == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, small_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    df = QUERIES[name](spark, small_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    assert digest(df.columns, rows)[0] == digest([d[0] for d in cur.description], cur.fetchall())[0]


@pytest.mark.parametrize("name", ["op8_chat_formatting", "op9_secret_scans"])
def test_native_operators_run_no_python(spark, small_dir, name):
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Scan ExistingRDD")) or name == "op8_chat_formatting"
    assert "Python" not in plan and "ArrowEval" not in plan
