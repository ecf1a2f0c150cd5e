"""The documents table through the stages that make training text of it.

Each stage takes what the one before it kept, over whole tables. `STAGES` can be run one by one with a table written between two
stages, which is also what a restart after a failure needs: a stage reads its input and nothing that an earlier one held.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.bpe import token_rows
from tallyhouse.llm.decontaminate import keep_clean
from tallyhouse.llm.neardup import keep_one
from tallyhouse.llm.pii import replace_pii
from tallyhouse.llm.quality import keep_good
from tallyhouse.session import tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A null or empty text is scored as one with 0 in every feature. Equal texts have equal scores, so copies stay or go together;
    a score equal to the threshold stays. Without usable labels every score is 0.5 and all rows stay.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Documents without words, null ones among them, are one group. Rows without an id stay all. Of rows with equal ids and words
    one stays, that with the smallest text, then the smallest other columns as JSON; with different words each is judged by its own.
    """
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a test item.

    A text without words has none, so null and empty ones stay. Items without words say nothing; with no items all rows stay.
    """
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; texts keep their length, so n_chars holds.

    Equal values get equal pseudonyms in all rows; of overlapping finds the one that the operator ranks first is replaced. No row
    goes: null and empty texts stay as they are.
    """
    return replace_pii(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with hashes of them and of the text they decode to.

    One row a row; a null or empty text has no ids. Columns but doc_id and text end here.
    """
    return token_rows(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("bpe", bpe),
]
ORACLE_SQL = None  # no stage but the third has a form in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
