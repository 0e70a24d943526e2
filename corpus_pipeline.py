"""A corpus pipeline: toxicity, line dedup, near duplicates, decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the docs of the next one. All but the last return the columns of documents; stages
that change texts set ``n_chars`` to the new length. The last adds token ids, their number, and
the text that the ids decode to. SQL cannot express the trained first stage, so there is no SQL
for the rows of ``run``; the stages are tested against brute force one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from staywarehouse.llm import decontaminate, jaccard, pieces, templates, toxicity
from staywarehouse.llm.queries import tokenizer_path
from staywarehouse.llm.scratch import reachable, settled


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else docs


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.accepted(docs, _table(reachable(spark), sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur stay in one document; others lose them."""
    return _counted(templates.cleaned(docs))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents lose passages of benchmark items."""
    return _counted(decontaminate.cleaned(docs, _table(reachable(spark), sf_dir, "benchmark")))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``ids``, ``decoded`` and ``n_tokens``."""
    reachable(spark)
    ids, decoded, count = (pieces.free(n, docs.columns) for n in ("ids", "decoded", "n_tokens"))
    found = pieces.round_trip(docs, tokenizer_path(), ids=ids, decoded=decoded)
    return found.withColumn(count, F.size(F.col(f"`{ids}`")).cast("long"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", tokens_stage),
]

#: No SQL: the first stage is a trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(reachable(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
