"""The numbered queries of this subpackage and their check SQL.

A query applies its operator to the whole of its table with the parameters of the
operator's defaults. Where SQL cannot express one, tests/llm holds a brute-force
version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldfit.llm import backoff, blob_ledger, block_naming, chat_format, language, mih, packing, periodic_runs, sentence_pieces, simhash, spelling, text_density, token_counts
from fieldfit.llm.common import table
from fieldfit.session import tune


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest neighbours in ``embeddings``."""
    return mih.neighbours(table(tune(spark), sf_dir, "embeddings"))


def op2_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of ``pages``."""
    return text_density.extract(table(tune(spark), sf_dir, "pages"))


def op3_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of ``documents``."""
    return language.languages(table(tune(spark), sf_dir, "documents"))


def op4_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents``."""
    return block_naming.exact_duplicates(table(tune(spark), sf_dir, "documents")).drop("text_key")


def op5_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of ``documents``."""
    return token_counts.token_counts(table(tune(spark), sf_dir, "documents"))


def op6_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 4096 tokens."""
    return packing.pack_documents(table(tune(spark), sf_dir, "documents"))


def op7_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece encoding and decoding of ``documents``."""
    return sentence_pieces.round_trips(table(tune(spark), sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of ``documents``."""
    return simhash.near_duplicates(table(tune(spark), sf_dir, "documents")).drop("text_key")


def op9_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of ``documents`` against the rest of the corpus."""
    return backoff.scores(table(tune(spark), sf_dir, "documents"))


def op10_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in ``documents``, scanned through a new ledger."""
    return blob_ledger.report(table(tune(spark), sf_dir, "documents"))


def op11_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as event logs, folded and formatted."""
    return chat_format.report(tune(spark), sf_dir)


def op12_basic_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in ``documents`` with planted tails."""
    return periodic_runs.report(table(tune(spark), sf_dir, "documents"))


def op13_trie_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of ``documents``."""
    return spelling.report(table(tune(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_multi_index_hashing, op2_text_density, op3_language_crf, op4_block_naming, op5_token_transducer, op6_bin_completion, op7_streaming_viterbi, op8_simhash, op9_stupid_backoff, op10_blob_ledger, op11_event_sourced_chat, op12_basic_factors, op13_trie_frontier)
}
SQL: dict[str, str] = {"op4_block_naming": block_naming.SQL, "op10_blob_ledger": blob_ledger.SQL, "op11_event_sourced_chat": chat_format.SQL}
