"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfeed.functions import arrays
from loomfeed.functions import text as texts
from loomfeed.operators import (
    add_characters,
    assign_batches,
    augment,
    augment_report,
    build_vocab,
    collate,
    count_words,
    encode_pieces,
    encode_words,
    epochs,
    finish_ids,
    from_step,
    grow_vocab,
    keyed_epochs,
    merge_counts,
    observe_report,
    prompt_full,
    prompt_optional_input,
    renumber,
    replicate,
    row_at,
    row_keys,
    split,
    split_by_hash,
    tokenize_batches,
    vary_columns,
    vary_slots,
    vocab_of_counts,
    word_level_json,
)
from loomfeed.operators.vocab import BOS_ID, EOS_ID, PAD_ID
from loomfeed.plans.examples import examples_from_conversations as examples
from loomfeed.plans.prepare import prepare_v1, prepare_v2, render_v1, render_v2
from loomfeed.session import checkpoint, fresh_path
from loomfeed.sources import (
    NA_WORDS,
    ingest_examples,
    normalize_missing,
    read_examples,
    read_planned,
    read_shards,
    write_examples,
    write_planned,
    write_shards,
)
from loomfeed.streaming import BatchReports, stream_examples, write_available, write_files_available

SEED = 42
COPIES = 3
LENGTH = 512
VOCAB = 4000
DOCUMENT_VOCAB = 32_000
PIECES = 8000
RESUMED = 5
EPOCHS = 3
BATCH, WORLD, ACCUM = 2, 3, 2
TEST_SIZE = 0.1

KEY = ["ex_id", "copy_id"]
TEXTS = ["instruction", "input", "output"]


def as_text(name: str) -> Column:
    """An integer array as text, so that results compare across engines."""
    return F.array_join(F.col(name).cast("array<string>"), " ").alias(name)


def as_padded_text(name: str, size: Column, side: str = "right") -> Column:
    """:func:`as_text` of an array whose places but the first (``side="left"``: last) ``size`` are filled.

    Where no filled place differs from the outermost, that one is printed once and
    repeated: an array as wide as the longest text is nearly all fill.
    """
    ids, fill = F.col(name), F.size(F.col(name)) - size
    first, outer = (1, -1) if side == "right" else (fill + 1, 1)
    body, outer = F.slice(ids, first, size), F.try_element_at(ids, F.lit(outer))
    # as many other values in all as outside the fill
    alike = outer.isNotNull() & (F.size(F.array_remove(ids, outer)) == F.size(F.array_remove(body, outer)))
    one = outer.cast("string")
    filled = F.when(fill > 0, F.concat(F.repeat(F.concat(one, F.lit(" ")), fill - 1), one))
    listed = F.when(size > 0, F.array_join(body.cast("array<string>"), " "))
    parts = [listed, filled] if side == "right" else [filled, listed]
    return F.when(alike, F.concat_ws(" ", *parts)).otherwise(as_text(name)).alias(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate(examples(spark, sf_dir), COPIES)


def vocab_of(prompts: DataFrame, size: int = VOCAB, col: str = "prompt") -> DataFrame:
    """A stored vocabulary, as a trained tokenizer would be."""
    return checkpoint(build_vocab(prompts, col, size))


def example_ids(spark: SparkSession, sf_dir: str, max_length: int = LENGTH) -> DataFrame:
    prompts = render_v2(examples(spark, sf_dir), repeat_count=COPIES, seed=SEED)
    return encode_words(prompts, vocab_of(prompts), max_length).drop("prompt")


def document_ids(spark: SparkSession, sf_dir: str, max_length: int = LENGTH) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vocab = vocab_of(docs, DOCUMENT_VOCAB, "text")
    return encode_words(docs, vocab, max_length, text="text").drop("text")


def longest_text(spark: SparkSession, sf_dir: str) -> int:
    """Words of the longest document: no text is cut at this length."""
    return documents(spark, sf_dir).select(F.max(F.size(arrays.words(F.col("text"))))).first()[0]


def example_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The examples as CSV files, columns in another order and with one more."""
    path = fresh_path(spark, name)
    write_csv(examples(spark, sf_dir).select(F.length("output").alias("extra"), "output", "input", "instruction"), path)
    return path


def write_csv(df: DataFrame, path: str, line_sep: str = "\n") -> None:
    (
        df.write.options(header=True, quoteAll=True, escape='"', lineSep=line_sep)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .mode("append")
        .csv(path)
    )


def ordered_example_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The examples as CSV files, in the order of their ids over files and lines."""
    path = fresh_path(spark, name)
    write_csv(examples(spark, sf_dir).orderBy("ex_id").select(*TEXTS), path)
    return path


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as examples: texts with line breaks and quotes."""
    columns = [F.col("text").alias("instruction"), F.col("source").alias("input"), F.col("lang").alias("output")]
    return documents(spark, sf_dir).select("doc_id", *columns)


def mixed_document_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The documents as CSV files of two kinds: other line ends, other order of columns."""
    path, cells = fresh_path(spark, name), document_cells(spark, sf_dir)
    english = F.coalesce(F.col("output") == "en", F.lit(False))
    write_csv(cells.filter(english).select(*TEXTS), path)
    write_csv(cells.filter(~english).select("doc_id", *TEXTS[::-1]), path, "\r\n")
    return path


# sources and sinks


def scan_instruction_csv(spark, sf_dir):
    return read_examples(spark, example_csv(spark, sf_dir, "scan")).select(*TEXTS)


def scan_row_index(spark, sf_dir):
    path = fresh_path(spark, "ordered")
    write_csv(document_cells(spark, sf_dir).orderBy("doc_id").select(*TEXTS), path)
    return ingest_examples(spark, path).select("row_index", *TEXTS)


def scan_mixed_headers(spark, sf_dir):
    return read_examples(spark, mixed_document_csv(spark, sf_dir, "mixed")).select(*TEXTS)


def normalize_missing_words(spark, sf_dir):
    planted = F.element_at(
        F.array(*[F.lit(w) for w in NA_WORDS]), (F.col("doc_id") % len(NA_WORDS) + 1).cast("int")
    )
    cell = F.when(F.col("doc_id") % 2 == 0, planted).otherwise(F.col("source"))
    return documents(spark, sf_dir).select("doc_id", normalize_missing(cell).alias("cell"))


def stream_instruction_csv(spark, sf_dir):
    path, out = example_csv(spark, sf_dir, "stream"), fresh_path(spark, "streamed")
    prompts = render_v2(stream_examples(spark, path), repeat_count=COPIES, seed=SEED)
    write_available(prompts, out, fresh_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).select("ex_id", "copy_id", "prompt")


def stream_csv_files(spark, sf_dir):
    path, out = mixed_document_csv(spark, sf_dir, "files"), fresh_path(spark, "streamed")

    def prompts(rows):
        return render_v2(rows, repeat_count=COPIES, seed=SEED)

    write_files_available(spark, path, out, fresh_path(spark, "progress"), prompts).awaitTermination()
    return spark.read.parquet(out).select("ex_id", "copy_id", "prompt")


def write_examples_parquet(spark, sf_dir):
    path = fresh_path(spark, "examples")
    write_examples(split(copies(spark, sf_dir), TEST_SIZE, SEED), path)
    return spark.read.parquet(path).select(*KEY, *TEXTS, "split")


def write_planned_parquet(spark, sf_dir):
    """Files of planned size per split, read back by their manifest."""
    path = fresh_path(spark, "planned")
    write_planned(split(copies(spark, sf_dir), TEST_SIZE, SEED), path)
    return read_planned(spark, path).select(*KEY, *TEXTS, "split")


def row_keys_by_content(spark, sf_dir):
    return row_keys(documents(spark, sf_dir).select("text")).select("ex_id", "text")


# predicates and switches


def skip_absent_column(spark, sf_dir):
    words = {"instruction": ["Instruction:", "Task:"], "absent": ["Absent:", "Present:"]}
    return vary_columns(copies(spark, sf_dir), words, SEED).select(*KEY, *TEXTS)


def cast_text(spark, sf_dir):
    return examples(spark, sf_dir).select(
        texts.text_of("ex_id").alias("ex_id"),
        texts.text_of("input").alias("kept"),
        texts.text_of("input", "nan").alias("filled"),
    )


def contains_keyword(spark, sf_dir):
    return examples(spark, sf_dir).select(
        "ex_id",
        texts.contains_keyword("instruction", "Instruction:").cast("int").alias("in_instruction"),
        texts.contains_keyword("input", "Input:").cast("int").alias("in_input"),
    )


def has_input(spark, sf_dir):
    return examples(spark, sf_dir).select("ex_id", texts.has_input("input").cast("int").alias("present"))


def drop_source_columns(spark, sf_dir):
    wide = examples(spark, sf_dir).withColumn("extra", F.length("output"))
    prompts = render_v2(wide, apply=False)
    return finish_ids(encode_words(prompts, vocab_of(prompts), LENGTH).drop("prompt"), LENGTH, PAD_ID).select(
        *KEY, as_text("input_ids"), as_text("attention_mask"), as_text("labels")
    )


def augment_switches(spark, sf_dir):
    df = examples(spark, sf_dir)
    cases = {
        "off": augment(df, False, COPIES, {"instruction": ["Instruction:", "Task:"]}),
        "nothing_to_do": augment(df, True, 1, {}),
        "one_word": augment(df, True, 1, {"instruction": ["Instruction:"]}),
        "copies_only": augment(df, True, 2, {}),
    }
    out = None
    for name, case in cases.items():
        case = case.select(F.lit(name).alias("mode"), *KEY, *TEXTS)
        out = case if out is None else out.unionByName(case)
    return out


# copies


def replicate_rows(spark, sf_dir):
    return copies(spark, sf_dir).select(*KEY, "instruction")


def equal_rows(spark, sf_dir):
    """Documents keyed by their text: many equal keys, and every tenth one null."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    key = F.when(F.col("doc_id") % 10 != 0, texts.content_key(["text"]))
    return replicate(docs.select(key.alias("ex_id")), COPIES)


def renumber_equal_rows(spark, sf_dir):
    return renumber(equal_rows(spark, sf_dir)).select("row_index", *KEY)


def renumber_rows(spark, sf_dir):
    return renumber(copies(spark, sf_dir)).select("row_index", *KEY)


# text


def replace_all(spark, sf_dir):
    return examples(spark, sf_dir).select("ex_id", texts.replace_all("input", "Input:", "Context:").alias("input"))


def replace_first(spark, sf_dir):
    return examples(spark, sf_dir).select("ex_id", texts.replace_first("input", "Input:", "Context:").alias("input"))


def variant_candidates(spark, sf_dir):
    listed = texts.candidates("input", "Input:", ["Context:", "Output:", "Response:"])
    return examples(spark, sf_dir).select("ex_id", F.posexplode(listed).alias("place", "candidate"))


def uniform_choice(spark, sf_dir):
    keys = [F.col("ex_id"), F.col("copy_id"), F.lit("instruction")]
    return copies(spark, sf_dir).select(
        *KEY, texts.choose(["Task:", "Objective:", "Goal:"], SEED, keys).alias("chosen")
    )


def vary_slots_v1(spark, sf_dir):
    return vary_slots(copies(spark, sf_dir), seed=SEED).select(*KEY, *TEXTS)


def vary_columns_v2(spark, sf_dir):
    return vary_columns(copies(spark, sf_dir), seed=SEED).select(*KEY, *TEXTS)


def vary_columns_literal_nan(spark, sf_dir):
    return vary_columns(copies(spark, sf_dir), seed=SEED, null_literal="nan").select(*KEY, *TEXTS)


def prompt_full_v1(spark, sf_dir):
    return prompt_full(examples(spark, sf_dir)).select("ex_id", "prompt")


def prompt_optional_input_v2(spark, sf_dir):
    return prompt_optional_input(examples(spark, sf_dir)).select("ex_id", "prompt")


# tokens


def tokenize_with_json(spark, sf_dir):
    prompts = render_v2(examples(spark, sf_dir), repeat_count=COPIES, seed=SEED)
    model = word_level_json(vocab_of(prompts))
    return tokenize_batches(prompts, model, LENGTH).select(*KEY, as_text("ids"))


def build_vocab_of_prompts(spark, sf_dir):
    return build_vocab(render_v2(examples(spark, sf_dir), repeat_count=COPIES, seed=SEED), size=VOCAB)


def build_vocab_of_documents(spark, sf_dir):
    return build_vocab(documents(spark, sf_dir), "text", DOCUMENT_VOCAB)


def grow_vocab_by_batches(spark, sf_dir):
    """Words of the English documents first, then of all, from stored counts of two batches."""
    docs = documents(spark, sf_dir).select("lang", "text")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    first, second = (checkpoint(count_words(docs.filter(part), "text")) for part in (english, ~english))
    old = checkpoint(vocab_of_counts(first, VOCAB))
    return grow_vocab(old, checkpoint(merge_counts(first, second)), DOCUMENT_VOCAB)


def encode_document_pieces(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    vocab = checkpoint(add_characters(vocab_of(docs, PIECES, "text"), docs, "text"))
    return encode_pieces(docs, vocab, LENGTH, text="text").select("doc_id", as_text("ids"))


def encode_prompts(spark, sf_dir):
    return example_ids(spark, sf_dir).select(*KEY, as_text("ids"))


def encode_prompts_shuffled(spark, sf_dir):
    prompts = render_v2(examples(spark, sf_dir), repeat_count=COPIES, seed=SEED)
    # as if the vocabulary were too big: frequent words looked up, the others joined
    ids = encode_words(prompts, vocab_of(prompts), LENGTH, max_inline_bytes=0, frequent_words=100)
    return ids.select(*KEY, as_text("ids"))


def encode_by_source(spark, sf_dir, **options):
    """Documents under a key that repeats and is sometimes null, special ids around."""
    source = F.when(F.col("doc_id") % 10 != 0, F.col("source"))
    docs = documents(spark, sf_dir).select(source.alias("source"), "text")
    vocab = vocab_of(docs, DOCUMENT_VOCAB, "text")
    ids = encode_words(docs, vocab, LENGTH, text="text", bos_id=BOS_ID, eos_id=EOS_ID, **options)
    return ids.select("source", as_text("ids"))


def encode_words_special_ids(spark, sf_dir):
    return encode_by_source(spark, sf_dir)


def encode_words_shuffled_special_ids(spark, sf_dir):
    return encode_by_source(spark, sf_dir, max_inline_bytes=0, frequent_words=1000)


def truncate_ids(spark, sf_dir):
    ids = document_ids(spark, sf_dir, 4 * LENGTH)
    return ids.select("doc_id", arrays.truncate(F.col("ids"), LENGTH).alias("ids")).select("doc_id", as_text("ids"))


def pad_max_length(spark, sf_dir):
    length = longest_text(spark, sf_dir)
    ids = document_ids(spark, sf_dir, length)
    padded = {f"pad_{side}": arrays.pad(F.col("ids"), length, PAD_ID, side) for side in ("left", "right")}
    texts_of = [as_padded_text(f"pad_{side}", F.size("ids"), side) for side in ("left", "right")]
    return ids.withColumns(padded).select("doc_id", *texts_of)


def pad_longest(spark, sf_dir):
    ids = assign_batches(epochs(example_ids(spark, sf_dir), 1, SEED), 4, 2, 1)
    out = finish_ids(ids, LENGTH, PAD_ID, padding="longest")
    return out.select(*KEY, as_text("input_ids"), as_text("attention_mask"))


def attention_mask(spark, sf_dir):
    length = longest_text(spark, sf_dir)
    ids = document_ids(spark, sf_dir, length)
    masks = {f"mask_{side}": arrays.attention_mask(F.col("ids"), length, side) for side in ("left", "right")}
    texts_of = [as_padded_text(f"mask_{side}", F.size("ids"), side) for side in ("left", "right")]
    return ids.withColumns(masks).select("doc_id", *texts_of)


def mask_labels(spark, sf_dir):
    length = longest_text(spark, sf_dir)
    # the labels of the padded ids, without a look at each filled place
    labels = arrays.padded_labels(F.col("ids"), length, PAD_ID)
    ids = document_ids(spark, sf_dir, length).withColumn("labels", labels)
    return ids.select("doc_id", as_padded_text("labels", F.size("ids")))


def pad_token_fallback(spark, sf_dir):
    docs, length = documents(spark, sf_dir).select("doc_id", "text"), longest_text(spark, sf_dir) + 1
    vocab = vocab_of(docs, DOCUMENT_VOCAB, "text")
    ended = encode_words(docs, vocab, length, text="text", eos_id=EOS_ID).drop("text")
    out = finish_ids(ended.withColumn("size", F.size("ids")), length, pad_id=None, eos_id=EOS_ID)
    names = ("input_ids", "attention_mask", "labels")
    return out.select("doc_id", *[as_padded_text(name, F.col("size")) for name in names])


# report and feed


def augment_report_counts(spark, sf_dir):
    return augment_report(copies(spark, sf_dir))


def augment_report_stream(spark, sf_dir):
    """The counts of all micro-batches, added up."""
    rows = stream_examples(spark, example_csv(spark, sf_dir, "report"), max_files_per_trigger=1)
    with BatchReports(spark, "augment") as reports:
        counted = observe_report(replicate(rows, COPIES), "augment")
        query = write_available(counted, fresh_path(spark, "streamed"), fresh_path(spark, "progress"))
        query.awaitTermination()
        batches = reports.of(query).values()
    totals = tuple(sum(b[c] for b in batches) for c in ("rows_before", "rows_after"))
    return spark.createDataFrame([totals], "rows_before long, rows_after long")


def train_test_split(spark, sf_dir):
    return split(copies(spark, sf_dir), TEST_SIZE, SEED).select(*KEY, "split")


def train_test_split_by_hash(spark, sf_dir):
    return split_by_hash(copies(spark, sf_dir), TEST_SIZE, SEED).select(*KEY, "split")


def epoch_shuffle(spark, sf_dir):
    return epochs(copies(spark, sf_dir).select(*KEY), EPOCHS, SEED)


def keyed_places(spark, sf_dir):
    rows = checkpoint(renumber(copies(spark, sf_dir).select(*KEY)))
    total = rows.count()
    return keyed_epochs(rows, EPOCHS, total, SEED), total


def epoch_keyed(spark, sf_dir):
    placed, total = keyed_places(spark, sf_dir)
    back = row_at("position", total, SEED, F.col("epoch"))
    return placed.select(*KEY, "epoch", "position", back.alias("row_index"))


def epoch_resumed(spark, sf_dir):
    rest = from_step(keyed_places(spark, sf_dir)[0], RESUMED, BATCH, WORLD, ACCUM)
    return assign_batches(rest, BATCH, WORLD, ACCUM).select(*KEY, "epoch", "rank", "micro", "step", "slot")


def epoch_shuffle_equal_rows(spark, sf_dir):
    return epochs(equal_rows(spark, sf_dir), EPOCHS, SEED)


def train_test_split_equal_rows(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source")
    return split(docs, TEST_SIZE, SEED, key="source")


def assign_batches_of_epochs(spark, sf_dir):
    placed = assign_batches(epoch_shuffle(spark, sf_dir), BATCH, WORLD, ACCUM)
    return placed.select(*KEY, "epoch", "rank", "micro", "step", "slot")


def collate_causal_lm(spark, sf_dir):
    ready = finish_ids(example_ids(spark, sf_dir), LENGTH, PAD_ID, labels=False)
    batches = collate(assign_batches(epochs(ready, EPOCHS, SEED), BATCH, WORLD, ACCUM), PAD_ID)

    def flat(name):
        return F.array_join(F.flatten(name).cast("array<string>"), " ").alias(name)

    return batches.select(
        "epoch", "step", "micro", "rank", as_text("ex_id"), as_text("copy_id"),
        flat("input_ids"), flat("attention_mask"), flat("labels"),
    )


def tensor_shards(spark, sf_dir):
    """Epochs in feed order as shards for a trainer, with the number of each row in them."""
    path = fresh_path(spark, "shards")
    ready = finish_ids(example_ids(spark, sf_dir), LENGTH, PAD_ID)
    feed = epochs(ready, EPOCHS, SEED).orderBy("epoch", "position")
    places = ["epoch", "position", "copy_id"]  # texts have no width and stay behind
    write_shards(feed.select(*places, "input_ids", "attention_mask", "labels"), path)
    rows = read_shards(spark, path, row="place")
    return rows.select(*places, "place", as_text("input_ids"), as_text("attention_mask"), as_text("labels"))


# whole preparations


def prepare_dataset_v1(spark, sf_dir):
    df = examples(spark, sf_dir)
    vocab = vocab_of(render_v1(df, COPIES, seed=SEED))
    out = prepare_v1(df, vocab, max_length=LENGTH, repeat_count=COPIES, seed=SEED)
    return out.select(*KEY, as_text("input_ids"), as_text("attention_mask"))


def _prepared_v2(df, **options):
    vocab = vocab_of(render_v2(df, repeat_count=COPIES, seed=SEED, **options))
    out = prepare_v2(df, vocab, max_length=LENGTH, repeat_count=COPIES, seed=SEED, **options)
    return out.select(*KEY, as_text("input_ids"), as_text("attention_mask"), as_text("labels"))


def prepare_dataset_v2(spark, sf_dir):
    return _prepared_v2(examples(spark, sf_dir))


def prepare_dataset_v2_literal_nan(spark, sf_dir):
    return _prepared_v2(examples(spark, sf_dir), null_literal="nan")


def prepare_dataset_v2_from_csv(spark, sf_dir):
    return _prepared_v2(read_examples(spark, example_csv(spark, sf_dir, "prepare")))


def _ingested(spark, sf_dir, render):
    """Examples keyed by their place in the files, and a vocabulary of their prompts."""
    df = ingest_examples(spark, ordered_example_csv(spark, sf_dir, "ingest"), index="ex_id")
    return df, vocab_of(render(df, repeat_count=COPIES, seed=SEED))


def prepare_dataset_v1_row_index(spark, sf_dir):
    df, vocab = _ingested(spark, sf_dir, render_v1)
    out = prepare_v1(df, vocab, max_length=LENGTH, repeat_count=COPIES, seed=SEED)
    return out.select(*KEY, as_text("input_ids"), as_text("attention_mask"))


def prepare_dataset_v2_row_index(spark, sf_dir):
    df, vocab = _ingested(spark, sf_dir, render_v2)
    out = prepare_v2(df, vocab, max_length=LENGTH, repeat_count=COPIES, seed=SEED)
    return out.select(*KEY, as_text("input_ids"), as_text("attention_mask"), as_text("labels"))


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "scan_instruction_csv": scan_instruction_csv,
    "scan_row_index": scan_row_index,
    "scan_mixed_headers": scan_mixed_headers,
    "normalize_missing": normalize_missing_words,
    "stream_instruction_csv": stream_instruction_csv,
    "stream_csv_files": stream_csv_files,
    "write_examples": write_examples_parquet,
    "write_planned": write_planned_parquet,
    "row_keys": row_keys_by_content,
    "skip_absent_column": skip_absent_column,
    "cast_text": cast_text,
    "contains_keyword": contains_keyword,
    "has_input": has_input,
    "drop_source_columns": drop_source_columns,
    "augment_switches": augment_switches,
    "replicate": replicate_rows,
    "renumber": renumber_rows,
    "renumber_equal_rows": renumber_equal_rows,
    "replace_all": replace_all,
    "replace_first": replace_first,
    "variant_candidates": variant_candidates,
    "uniform_choice": uniform_choice,
    "vary_slots": vary_slots_v1,
    "vary_columns": vary_columns_v2,
    "vary_columns_literal_nan": vary_columns_literal_nan,
    "prompt_full": prompt_full_v1,
    "prompt_optional_input": prompt_optional_input_v2,
    "tokenize_batches": tokenize_with_json,
    "build_vocab": build_vocab_of_prompts,
    "build_vocab_documents": build_vocab_of_documents,
    "grow_vocab": grow_vocab_by_batches,
    "encode_pieces": encode_document_pieces,
    "encode_words": encode_prompts,
    "encode_words_shuffled": encode_prompts_shuffled,
    "encode_words_special_ids": encode_words_special_ids,
    "encode_words_shuffled_special_ids": encode_words_shuffled_special_ids,
    "truncate": truncate_ids,
    "pad_max_length": pad_max_length,
    "pad_longest": pad_longest,
    "attention_mask": attention_mask,
    "mask_labels": mask_labels,
    "pad_token_fallback": pad_token_fallback,
    "augment_report": augment_report_counts,
    "augment_report_stream": augment_report_stream,
    "train_test_split": train_test_split,
    "train_test_split_by_hash": train_test_split_by_hash,
    "epoch_shuffle": epoch_shuffle,
    "epoch_keyed": epoch_keyed,
    "epoch_resumed": epoch_resumed,
    "epoch_shuffle_equal_rows": epoch_shuffle_equal_rows,
    "train_test_split_equal_rows": train_test_split_equal_rows,
    "assign_batches": assign_batches_of_epochs,
    "collate_causal_lm": collate_causal_lm,
    "tensor_shards": tensor_shards,
    "prepare_dataset_v1": prepare_dataset_v1,
    "prepare_dataset_v2": prepare_dataset_v2,
    "prepare_dataset_v2_literal_nan": prepare_dataset_v2_literal_nan,
    "prepare_dataset_v2_from_csv": prepare_dataset_v2_from_csv,
    "prepare_dataset_v1_row_index": prepare_dataset_v1_row_index,
    "prepare_dataset_v2_row_index": prepare_dataset_v2_row_index,
}
