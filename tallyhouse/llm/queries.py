"""The numbered queries of this subpackage over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.sql import ORACLE_SQL
from tallyhouse.session import tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.substring import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents")).drop("removed")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tallyhouse.llm.bpe import encode_digests

    return encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.decontaminate import digest, find_contamination

    return digest(find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))).drop("hits")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.neardup import classes

    return classes(_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.pii import find_pii

    return find_pii(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.secrets import digest, find_secrets

    return digest(find_secrets(_table(spark, sf_dir, "documents")))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.html import extract

    return extract(_table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.rules import POLICIES, apply_policy, ledger, mask_of

    checked = apply_policy(ledger(_table(spark, sf_dir, "documents")))
    base = checked["failed"].bitwiseAND(F.lit(mask_of(POLICIES[1]))) != 0
    return checked.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed", "n_lines", "n_capitals")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.quality import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.gru import score

    return score(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.whitening import components_of

    return components_of(_table(spark, sf_dir, "embeddings"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.urls import judge

    judged = judge(_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "weight", F.size("strict").cast("long").alias("n_strict"), F.size("soft").cast("long").alias("n_soft"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.runs import digest, find_runs, planted

    docs = _table(spark, sf_dir, "documents")
    return digest(find_runs(docs.select("doc_id", planted(docs["doc_id"], docs["text"]).alias("text"))))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_bpe, op3_decontamination, op4_near_dedup, op5_pii, op6_secret_scan, op7_html_extraction, op8_quality_rules, op9_quality_classifier, op10_lm_scoring, op11_embedding_whitening, op12_url_filter, op13_periodic_runs)}
__all__ = ["ORACLE_SQL", "QUERIES"]
