"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agorascope.llm import decontaminate, html_text, importance, language, lexical, licenses, packing, rules, rules_sql, secrets, sentence_pieces, simhash, tokens, urls


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op2_link_graph_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_read(spark, sf_dir, "pages"))


def op3_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_read(spark, sf_dir, "documents")))


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.judged(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "fail_bits")


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op7_byte_network_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_read(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_read(spark, sf_dir, "documents"))


def op9_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op10_scored_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build(_read(spark, sf_dir, "documents"))
    return lexical.search(index, _read(spark, sf_dir, "benchmark"))


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(_read(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_patience_licenses, op2_link_graph_urls, op3_golay_simhash, op4_markov_secrets, op5_rule_ledger, op6_spaced_seeds, op7_byte_network_language, op8_token_counts, op9_vector_best_fit, op10_scored_html, op11_lexical_search, op12_sentence_pieces, op13_importance_resampling)}


def oracle_sql() -> dict:
    return {"op5_rule_ledger": rules_sql.sql(rules.RULES, rules.BASE.rules), "op6_spaced_seeds": decontaminate.sql(), "op2_link_graph_urls": urls.sql(), "op11_lexical_search": lexical.sql()}
