"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from . import block_topk, decision_list, gru_lm, line_runs, lsh_forest, mixing, page_diff, rlz, sp_viterbi, weak_label
from .common import table


def op1_lm_scoring(spark, sf_dir):
    return gru_lm.score_documents(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_substring_dedup(spark, sf_dir):
    return rlz.duplicate_spans(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    return decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_classifier(spark, sf_dir):
    return weak_label.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_extraction(spark, sf_dir):
    return page_diff.page_texts(table(spark, sf_dir, "pages"))


def op7_top_k_search(spark, sf_dir):
    return block_topk.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark, sf_dir):
    return sp_viterbi.encode_documents(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark, sf_dir):
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark, sf_dir):
    return line_runs.dedup_lines(table(spark, sf_dir, "documents"), report=True)


def queries():
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql():
    return {"op7_top_k_search": block_topk.SQL, "op10_line_dedup": line_runs.SQL}
