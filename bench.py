"""Time the headline queries; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from loomfeed.plans import catalog as q  # noqa: E402
from loomfeed.operators.tokens import finish_ids  # noqa: E402
from loomfeed.plans.prepare import prepare_v1, prepare_v2, render_v1, render_v2  # noqa: E402
from loomfeed.session import builder, checkpoint  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
LENGTH = 512
VOCAB = 32_000
MANY = 60  # copies per example in the throughput cases, where fixed costs matter less


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = (
        builder("loomfeed-bench")
        .master(f"local[{CPUS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    # stored examples and documents, in as many files as there are cores, and a
    # trained tokenizer are the inputs of the preparation
    def stored(df):
        return checkpoint(df.repartition(int(CPUS)))

    examples = stored(q.examples(spark, SF_DIR))
    vocab = q.vocab_of(render_v2(examples), VOCAB)
    ready = stored(prepare_v2(examples, vocab, max_length=LENGTH))
    rows = examples.count()
    docs = stored(
        q.documents(spark, SF_DIR).select(F.col("doc_id").alias("ex_id"), F.lit(0).alias("copy_id"), "text")
    )
    doc_vocab = q.vocab_of(docs, VOCAB, "text")
    numbered = stored(q.renumber(ready.select(*q.KEY)))

    def encode_documents():
        ids = q.encode_words(docs, doc_vocab, LENGTH, text="text").drop("text")
        return finish_ids(ids, LENGTH, 0)

    def encode_shuffled():
        prompts = render_v2(examples, repeat_count=q.COPIES)
        ids = q.encode_words(prompts, vocab, LENGTH, max_inline_bytes=0).drop("prompt")
        return finish_ids(ids, LENGTH, 0)

    def feed(n=q.EPOCHS):
        return q.assign_batches(q.epochs(ready.select(*q.KEY), n), q.BATCH, q.WORLD, q.ACCUM)

    def collated():
        fed = q.assign_batches(q.epochs(ready.drop("labels"), q.EPOCHS), q.BATCH, q.WORLD, q.ACCUM)
        return q.collate(fed)

    cases = {
        "examples": lambda: q.examples(spark, SF_DIR),
        "render_v1": lambda: render_v1(examples),
        "render_v2": lambda: render_v2(examples),
        "prepare_v1": lambda: prepare_v1(examples, vocab, max_length=LENGTH),
        "prepare_v2": lambda: prepare_v2(examples, vocab, max_length=LENGTH),
        "prepare_v2_many": lambda: prepare_v2(examples, vocab, max_length=LENGTH, repeat_count=MANY),
        "build_vocab_documents": lambda: q.build_vocab(docs, "text", VOCAB),
        "encode_documents": encode_documents,
        "encode_shuffled": encode_shuffled,
        "prepare_v2_from_csv": lambda: q.prepare_dataset_v2_from_csv(spark, SF_DIR),
        "row_keys": lambda: q.row_keys(docs.select("text")),
        "stream_csv": lambda: q.stream_instruction_csv(spark, SF_DIR),
        "write_examples": lambda: q.write_examples_parquet(spark, SF_DIR),
        "scan_csv": lambda: q.scan_instruction_csv(spark, SF_DIR),
        "ingest_csv": lambda: q.scan_row_index(spark, SF_DIR),
        "encode_pieces": lambda: q.encode_pieces(docs, doc_vocab, LENGTH, text="text").drop("text"),
        "keyed_epochs": lambda: q.assign_batches(q.keyed_epochs(numbered, q.EPOCHS, rows * q.COPIES), q.BATCH, q.WORLD, q.ACCUM),
        "renumber": lambda: q.renumber(ready.select(*q.KEY)),
        "train_test_split": lambda: q.split(ready, q.TEST_SIZE),
        "epochs_and_batches": feed,
        "epochs_12": lambda: feed(12),
        "collate": collated,
    }
    seconds, failed = {}, {}
    for name, case in cases.items():
        best = float("inf")
        try:
            for _ in range(RUNS):
                start = time.perf_counter()
                drain(case())
                best = min(best, time.perf_counter() - start)
        except Exception as error:  # the other cases' figures are reported all the same
            failed[name] = str(error)[:200]
        else:
            seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, best of runs per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "prompts_per_sec": {k: round(rows * MANY / s) for k, s in seconds.items() if k == "prepare_v2_many"},
                "failed": failed,
            }
        )
    )


if __name__ == "__main__":
    main()
