"""The registered queries ``opN_<name>``: each applies its operator with production
parameters to its whole table.  ``ORACLE`` has DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventfeat.llm import (chat, decontam, htmltext, jaccard, linededup, packing, periods, pieces, quality, repair, repeats,
                           secrets, urls)
from eventfeat.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@_query("op1_quality_rules", quality.oracle_sql())
def op1(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"))


@_query("op8_chat_formatting", chat.ORACLE_SQL)
def op8(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    return chat.chat_digest(chat.format_chats(conv.unionByName(extra)))


@_query("op9_secret_scans")
def op9(spark, sf_dir):
    paths, _ = secrets.scan(table(spark, sf_dir, "documents"))
    return secrets.secret_report(paths)


@_query("op10_url_filters")
def op10(spark, sf_dir):
    return urls.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@_query("op7_line_dedup", linededup.oracle_sql())
def op7(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"))


@_query("op2_packing")
def op2(spark, sf_dir):
    return packing.piece_report(packing.pack(table(spark, sf_dir, "documents")))


@_query("op5_ngram_jaccard_join")
def op5(spark, sf_dir):
    return jaccard.links(table(spark, sf_dir, "documents"))


@_query("op6_suffix_array_dedup")
def op6(spark, sf_dir):
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


@_query("op3_benchmark_decontamination")
def op3(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op4_html_extraction")
def op4(spark, sf_dir):
    return htmltext.extract_text(table(spark, sf_dir, "pages"))


@_query("op11_periodic_run_detection")
def op11(spark, sf_dir):
    return periods.run_report(periods.find_runs(periods.with_periodic_tails(table(spark, sf_dir, "documents"))))


@_query("op12_conversation_structure_repair", repair.oracle_sql())
def op12(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return repair.repair_report(rows, *repair.repair_turns(repair.damaged(rows)))


@_query("op13_sentencepiece_encoding")
def op13(spark, sf_dir):
    return pieces.piece_digest(pieces.encode_pieces(table(spark, sf_dir, "documents")))
