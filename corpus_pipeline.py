"""A corpus pipeline made of the operators in `millrace.llm`: documents that are of good quality and in a
known language, one of each near-duplicate group, mixed by source, and encoded.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Defined results are
those of the operators; in short: null or empty text has no language and goes in the second stage,
documents without an id are judged like others but all stay in the third, an empty table gives no rows,
further columns are carried along up to the last stage, which gives ids, source, language and digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bytepair, langid, mixing, neardup, quality
from millrace.llm.chars import prepared
from millrace.llm.queries import held_out, table
from millrace.session import written

LEAST_QUALITY, LEAST_CERTAINTY = 0.5, 0.5
RANKS = "byte_bpe_multi_50k.tiktoken"


def kept(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, whatever their names are."""
    return found.select(*[F.col(f"`{name}`") for name in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of good quality is at least one half."""
    model = quality.co_train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, out="_quality")
    return kept(scored.where(F.col("_quality") >= LEAST_QUALITY), docs)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in one of the learned languages, with a probability of at least one half."""
    prepared(spark)
    model = langid.train(docs, ~held_out("doc_id"))
    found = langid.predict(docs, model, lang_pred="_lang", score="_certainty")
    known = (F.col("_lang") != langid.UNKNOWN) & (F.col("_certainty") >= LEAST_CERTAINTY)
    return kept(found.where(known), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    prepared(spark)
    return neardup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding."""
    prepared(spark)
    path = public_tokenizers.path(RANKS)
    texts = docs.select("doc_id", "source", "lang", "text")
    decoded = bytepair.encode(texts, path, decoded="decoded")
    same = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    sums = [c.alias(n) for n, c in bytepair.digests(decoded).items()]
    return decoded.select("doc_id", "source", "lang", "ids", *sums, same.alias("round_trip"))


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte pair encoding", encode_texts),
]

# The models, the alignment and the merges have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
