"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations


import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeed.llm import (
    decontaminate,
    importance,
    nearest,
    oracle,
    packing,
    personal,
    pitman_yor,
    prefix_trie,
    sharding,
    simhash,
    substrings,
    token_files,
    toxicity,
    warc,
)
from loomfeed.session import fresh_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_pitman_yor(spark, sf_dir):
    """Log probability of every text; six of seven texts are learned from."""
    return pitman_yor.score(documents(spark, sf_dir), toxicity.bucket("doc_id", 7) == 2)


def op2_substrings(spark, sf_dir):
    """Words of repeated 35-word windows, removed."""
    kept = substrings.remove_repeats(documents(spark, sf_dir))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


def op3_token_files(spark, sf_dir):
    """Token ids written to rANS files in doc_id order and read back."""
    folder = fresh_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), folder, TOKENIZER, end_id=2)
    return token_files.digests(token_files.read(spark, folder))


def op4_simhash(spark, sf_dir):
    """Components of SimHash fingerprints at most two bits apart."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op5_warc(spark, sf_dir):
    """Pages written as Zstandard WARC archives and read back."""
    folder = fresh_path(spark, "archives")
    found = warc.read(warc.write(table(spark, sf_dir, "pages"), folder))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_nearest(spark, sf_dir):
    """The 20 nearest of every twentieth vector, by inner product."""
    return nearest.search(table(spark, sf_dir, "embeddings"), queries_modulus=20)


def op7_toxicity(spark, sf_dir):
    """Toxicity of every text, learned from two thirds of the labels."""
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    return toxicity.add_scores(docs, model).select(
        "doc_id",
        (toxicity.bucket("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_sharding(spark, sf_dir):
    """Sixteen shards by the hash tree, and the shard of each row with one more."""
    return sharding.shard_documents(documents(spark, sf_dir), 16, 17)


def op9_packing(spark, sf_dir):
    """Pieces of at most 1024 tokens packed into sequences by cutting stock."""
    cut = packing.pieces(documents(spark, sf_dir), TOKENIZER, end_id=0)
    return packing.digests(cut, packing.place(cut))


def op10_decontaminate(spark, sf_dir):
    """Words of documents inside 10-word windows of the benchmark."""
    found = decontaminate.find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    items = F.array_join("items", ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op11_personal(spark, sf_dir):
    """Personal data: base spans with their counts and digest, and all spans."""
    found = personal.find_personal(documents(spark, sf_dir))
    return found.select("doc_id", *personal.digests(found))


def op12_importance(spark, sf_dir):
    """A quarter of the documents, drawn towards the benchmark's n-grams."""
    scored = importance.scores(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return importance.draw(scored).select("doc_id", "n_features", "weight", "score", "rank")


def op13_prefix_trie(spark, sf_dir):
    """The nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pitman_yor,
        op2_substrings,
        op3_token_files,
        op4_simhash,
        op5_warc,
        op6_nearest,
        op7_toxicity,
        op8_sharding,
        op9_packing,
        op10_decontaminate,
        op11_personal,
        op12_importance,
        op13_prefix_trie,
    )
}
ORACLE = oracle.ORACLE
