"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bytepair, html_text, langid, manifest, mixing, neardup, neighbours, quality, sharding, topk, toxicity, urls, whitening,
)
from .chars import prepared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = (
    urls.Rule("allow", "com"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its texts are handed to Python in small batches."""
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_mix_sources(spark, sf):
    """Words each document gives to a mix of the sources by weights 5, 2, 1, at most three times over."""
    plan = mixing.mix_plan(table(spark, sf, "documents"))
    return plan.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_times")).alias("taken"),
        F.col("_times").alias("times"),
    )


@query
def op7_shard_slots(spark, sf):
    """Documents in eight shards of near equal bytes."""
    docs = table(spark, sf, "documents")
    text = F.coalesce("text", F.lit(""))
    crc = F.crc32(text.cast("binary"))
    placed = sharding.shard_records(
        docs.withColumn("_crc", crc),
        keys=["doc_id", "_crc"],
        size=(F.octet_length(text) + 1).cast("long"),
        carry={"doc_id": F.col("doc_id"), "text_crc32": F.col("_crc")},
    )
    return placed.select(
        "doc_id",
        F.col("_size").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_place").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_slot").alias("virtual_slot"),
        F.col("_version").alias("map_version"),
    )


@query
def op9_url_filter(spark, sf):
    """Verdicts on pages by rule, else by their aliases."""
    return urls.judge(table(spark, sf, "pages"), RULES).drop("alias_root")


@query
def op2_block_neighbours(spark, sf):
    """The 20 nearest of every 20th vector by inner product."""
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("_id") % 20 == 0, 20)


@query
def op10_kd_top_k(spark, sf):
    """The 5 largest inner products of every 50th vector in whole numbers."""
    vectors = topk.whole_numbers(table(spark, sf, "embeddings"))
    found = topk.top_k(vectors, F.col("_id") % 50 == 0, 5)
    return found.withColumn("score", F.col("score").cast("long"))


@query
def op8_byte_pairs(spark, sf):
    """Token ids of every text and their decoding, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    decoded = bytepair.encode(docs, path, decoded="decoded")
    return decoded.select("doc_id", *[c.alias(n) for n, c in bytepair.digests(decoded).items()])


def held_out(ident):
    """Documents that no model learns from: crc32 of the id as text divisible by 5."""
    return F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit("")).cast("binary")) % 5 == 0


@query
def op4_language(spark, sf):
    """The language of every text."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, ~held_out("doc_id"))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op5_quality(spark, sf):
    """The quality of every document, judged by its content and its metadata."""
    docs = table(spark, sf, "documents")
    model = quality.co_train(docs, table(spark, sf, "labels"))
    found = quality.score(docs, model)
    kept = (F.col("quality_score") >= 0.5).alias("keep")
    return found.select("doc_id", "quality_score", "quality_score_content", "quality_score_metadata", kept)


@query
def op6_main_text(spark, sf):
    """The main text of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.learn(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op1_order_minhash(spark, sf):
    """The near-duplicate group of every document."""
    return neardup.groups(table(spark, sf, "documents"))


@query
def op11_toxicity(spark, sf):
    """The toxicity of every text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf, "labels").select("doc_id", "toxic"), ~held_out("doc_id"))
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op12_whitening(spark, sf):
    """Whitened vectors on up to 32 components."""
    return whitening.whiten(table(spark, sf, "embeddings"))


@query
def op13_manifest(spark, sf):
    """Leaf, roots and proof of every document, the proof tried on a changed text for every fifth id."""
    docs = table(spark, sf, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest.manifest(docs, tampered)
