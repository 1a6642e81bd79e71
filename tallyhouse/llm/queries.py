"""The operators' queries over the test tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import chat, fp_search, language, licenses, lines, merkle, mixing, ngram_join, pieces, pii, topk, toxicity, turn_trie
from tallyhouse.llm.tables import table
from tallyhouse.session import prepare


def _piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(prepare(spark), sf_dir)


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(prepare(spark), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.query(table(prepare(spark), sf_dir, "documents"), _piece_model())


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(table(prepare(spark), sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.query(table(prepare(spark), sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.query(table(prepare(spark), sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(table(prepare(spark), sf_dir, "conversations"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.query(table(prepare(spark), sf_dir, "documents"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.query(table(prepare(spark), sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.query(table(prepare(spark), sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.query(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.query(table(prepare(spark), sf_dir, "conversations"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.query(table(prepare(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_topk_search, op3_sentencepiece, op4_mixing, op5_line_dedup, op6_fingerprints, op7_chat_formatting, op8_pii, op9_ngram_join, op10_language_id,
                            op11_ranked_search, op12_turn_trie, op13_license_scan)
}

ORACLES: dict[str, str] = {"op2_topk_search": topk.ORACLE, "op4_mixing": mixing.ORACLE,
                           "op6_fingerprints": merkle.ORACLE, "op11_ranked_search": fp_search.ORACLE,
                           "op12_turn_trie": turn_trie.ORACLE, "op13_license_scan": licenses.ORACLE}
