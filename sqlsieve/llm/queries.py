"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, chat_format, decontamination, html_text, imatch, jaccard_join, periodic_runs, repeated_phrases,
    secrets, source_divergence, token_counts, toxicity, url_filters,
)
from .common import read

Run = Callable[[SparkSession, str], DataFrame]


def op1_bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read(spark, folder, "documents"))


def op2_grouped_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents")
    return jaccard_join.components_of(documents, width=3, threshold=Fraction(9, 10))


def op3_benchmark_edits(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(
        read(spark, folder, "documents"), read(spark, folder, "benchmark")
    )


def op4_redirect_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.page_verdicts(read(spark, folder, "pages"))


def op5_typed_parts(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.chat_digests(read(spark, folder, "conversations"))


def op6_randomness_battery(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_spans(read(spark, folder, "documents"))


def op7_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprints(read(spark, folder, "documents"))


def op8_prefix_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(read(spark, folder, "documents"))


def op9_toxicity_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op10_page_differences(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(read(spark, folder, "pages"))


def op11_dyadic_squares(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.run_digests(read(spark, folder, "documents"))


def op12_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_phrases.repeat_digests(read(spark, folder, "documents"))


def op13_pair_merge(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.divergence(read(spark, folder, "documents"))


QUERIES: dict[str, Run] = {
    "op1_bpe_tree": op1_bpe_tree,
    "op2_grouped_prefix_join": op2_grouped_prefix_join,
    "op3_benchmark_edits": op3_benchmark_edits,
    "op4_redirect_equivalence": op4_redirect_equivalence,
    "op5_typed_parts": op5_typed_parts,
    "op6_randomness_battery": op6_randomness_battery,
    "op7_imatch": op7_imatch,
    "op8_prefix_token_counts": op8_prefix_token_counts,
    "op9_toxicity_ngrams": op9_toxicity_ngrams,
    "op10_page_differences": op10_page_differences,
    "op11_dyadic_squares": op11_dyadic_squares,
    "op12_phrase_automata": op12_phrase_automata,
    "op13_pair_merge": op13_pair_merge,
}

SQL: dict[str, str] = {
    "op4_redirect_equivalence": url_filters.SQL,
    "op5_typed_parts": chat_format.SQL,
    "op13_pair_merge": source_divergence.SQL,
}
