"""Queries of this subpackage; each takes the session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .abuse import offence_rates, offending_messages, scored_messages
from .budget import token_budget, token_counts
from .common import read_table
from .encode import encode_texts
from .langid import document_languages, mislabelled
from .leakage import leaked_items
from .packing import pack_documents
from .pairs import defective_pairs, first_defects
from .spam import page_deviations, page_profiles, spam_pages
from .textstats import scored_statistics, text_statistics, unnatural_texts


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return unnatural_texts(read_table(spark, root, "dataset"), "id", "text")


def p1_statistics(spark: SparkSession, root: str) -> DataFrame:
    return scored_statistics(read_table(spark, root, "dataset"), "id", "text")


def p1_counts(spark: SparkSession, root: str) -> DataFrame:
    """Plain statistics of every row, without ranks."""
    rows = text_statistics(read_table(spark, root, "dataset"), "id", "text")
    return rows.select("id", F.col("words").cast("bigint").alias("words"), *(F.round(c, 6).alias(c) for c in ("word_length", "line_words", "comma_ratio", "digit_ratio")))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return first_defects(read_table(spark, root, "conversations"), "conv_id", "messages", read_table(spark, root, "lang_samples"))


def p2_defects(spark: SparkSession, root: str) -> DataFrame:
    return defective_pairs(read_table(spark, root, "conversations"), "conv_id", "messages", read_table(spark, root, "lang_samples"))


def p3_tokens(spark: SparkSession, root: str) -> DataFrame:
    return token_counts(read_table(spark, root, "dataset"), "id", "text")


def p3_slices(spark: SparkSession, root: str) -> DataFrame:
    return token_budget(read_table(spark, root, "dataset"), "id", "text")


def p3_documents(spark: SparkSession, root: str) -> DataFrame:
    """Documents of each slice."""
    return token_budget(read_table(spark, root, "dataset"), "id", "text").select("slice", "value", "documents")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return leaked_items(read_table(spark, root, "dataset"), "id", "text", read_table(spark, root, "benchmark"), "item_id", "text")


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return offending_messages(read_table(spark, root, "conversations"), "conv_id", "messages")


def p5_scores(spark: SparkSession, root: str) -> DataFrame:
    return scored_messages(read_table(spark, root, "conversations"), "conv_id", "messages")


def p5_rates(spark: SparkSession, root: str) -> DataFrame:
    return offence_rates(read_table(spark, root, "conversations"), "conv_id", "messages")


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return mislabelled(read_table(spark, root, "dataset"), "id", "text", "language", read_table(spark, root, "lang_samples"))


def p6_languages(spark: SparkSession, root: str) -> DataFrame:
    return document_languages(read_table(spark, root, "dataset"), "id", "text", read_table(spark, root, "lang_samples"))


def p7_ids(spark: SparkSession, root: str) -> DataFrame:
    return encode_texts(read_table(spark, root, "documents"), "doc_id", "text")


def p8_containers(spark: SparkSession, root: str) -> DataFrame:
    return pack_documents(read_table(spark, root, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return spam_pages(read_table(spark, root, "documents"), "doc_id", "text")


def p9_curves(spark: SparkSession, root: str) -> DataFrame:
    return page_deviations(page_profiles(read_table(spark, root, "documents"), "doc_id", "text"), "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_counts": p1_counts,
    "p1_statistics": p1_statistics,
    "p2_found": p2_found,
    "p2_defects": p2_defects,
    "p3_documents": p3_documents,
    "p3_slices": p3_slices,
    "p3_tokens": p3_tokens,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_rates": p5_rates,
    "p5_scores": p5_scores,
    "p6_found": p6_found,
    "p6_languages": p6_languages,
    "p7_ids": p7_ids,
    "p8_containers": p8_containers,
    "p9_found": p9_found,
    "p9_curves": p9_curves,
}
