"""Corpus preparation: toxicity, near copies, repeated passages, benchmark leaks, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; ``run`` writes each result to the shared folder and reads it
again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeed.llm import decontaminate, packing, simhash, substrings, toxicity
from loomfeed.llm.common import store
from loomfeed.llm.queries import TOKENIZER, table


def _wrapped(docs: DataFrame) -> DataFrame:
    """Key, text and one struct of all other columns, so that no name meets one an operator adds."""
    others = [F.col(f"`{n}`") for n in docs.columns if n not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others).alias("rest"))


def _unwrapped(done: DataFrame, names: list[str], is_changed=None) -> DataFrame:
    """The columns ``names`` again; ``n_chars`` follows where the text was changed."""
    rest = done.schema["rest"].dataType.names
    columns = {n: F.col("rest").getField(n) if n in rest else F.col(n) for n in names}
    if is_changed is not None and "n_chars" in rest:
        columns["n_chars"] = F.when(is_changed, F.length("text").cast("long")).otherwise(columns["n_chars"])
    return done.select(*[c.alias(n) for n, c in columns.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity reaches the threshold go; null and empty texts stay."""
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.add_scores(_wrapped(docs), model)
    return _unwrapped(scored.filter(F.col("score") < toxicity.THRESHOLD), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash (three-word shingles, two bits) the smallest id stays."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that occur twice are cut from the texts."""
    kept = substrings.remove_repeats(_wrapped(docs))
    return _unwrapped(kept, docs.columns, F.col("n_removed") > 0)


def cut_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut from the texts."""
    freed = decontaminate.cut_leaks(_wrapped(docs), table(spark, sf_dir, "benchmark"))
    return _unwrapped(freed, docs.columns, F.size("spans") > 0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their places in sequences."""
    cut = packing.pieces(docs, TOKENIZER, end_id=0)
    return packing.digests(cut, packing.place(cut))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", cut_leaks),
    ("packing", pack),
]

#: The toxicity model, SimHash and the tokenizer are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
