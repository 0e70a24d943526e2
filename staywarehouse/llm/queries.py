"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, decontaminate, hard_negatives, jaccard, perplexity, pieces, pii, pseudolm, secret_scan, shards,
               templates, toxicity, whitening)
from .oracle import STATEMENTS
from .scratch import reachable

#: The demonstration key of the registered query; a pipeline passes its own.
KEY = "registered-query-key"


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """A tokenizer file that the registered queries use."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{folder}/{name}.parquet")


def _over_documents(work: Callable[[DataFrame], DataFrame]):
    return lambda spark, folder: work(_table(spark, folder, "documents"))


def _with(other: str, work: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda spark, folder: work(_table(spark, folder, "documents"),
                                      _table(spark, folder, other))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_pseudonyms": _over_documents(lambda d: pii.report(d, KEY)),
    "op2_quality_perplexity": _over_documents(perplexity.report),
    "op3_decontamination": _with("benchmark", decontaminate.report),
    "op4_hash_tree_shards": _over_documents(shards.report),
    "op5_jaccard_join": _over_documents(jaccard.join),
    "op6_pseudo_likelihood": _over_documents(pseudolm.scored),
    "op7_toxicity": _with("labels", toxicity.report),
    "op8_sentencepiece": _over_documents(lambda d: pieces.digest(d, tokenizer_path())),
    "op9_secret_scan": _over_documents(secret_scan.report),
    "op10_line_templates": _over_documents(templates.report),
    "op11_whitening": lambda spark, folder: whitening.report(
        _table(spark, folder, "embeddings")),
    "op12_hard_negatives": lambda spark, folder: hard_negatives.report(
        _table(spark, folder, "embeddings")),
    "op13_pair_index_bpe": _over_documents(
        lambda d: bpe.digest(d, tokenizer_path("word_bpe_49k.json"))),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
