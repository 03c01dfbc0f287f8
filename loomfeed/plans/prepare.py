"""From an example table to model input, in the two generations of semantics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation

from loomfeed.operators.augment import COLUMN_WORDS, SLOT_WORDS, augment, replicate, vary_slots
from loomfeed.operators.checks import REQUIRED, require_columns
from loomfeed.operators.keys import row_keys
from loomfeed.operators.prompts import prompt_full, prompt_optional_input
from loomfeed.operators.report import observe_report
from loomfeed.operators.tokens import finish_ids, tokenize_batches
from loomfeed.operators.vocab import PAD_ID, encode_words


def _keyed(df: DataFrame) -> DataFrame:
    require_columns(df)
    if "ex_id" in df.columns:
        return df.select("ex_id", *REQUIRED)
    return row_keys(df.select(*REQUIRED))


def render_v1(
    df: DataFrame, repeat_count: int = 3, words: Sequence[str] = SLOT_WORDS, seed: int = 42
) -> DataFrame:
    """``(ex_id, copy_id, prompt)``: always augmented, full template."""
    varied = vary_slots(replicate(_keyed(df), repeat_count), words, seed)
    return prompt_full(varied).select("ex_id", "copy_id", "prompt")


def render_v2(
    df: DataFrame,
    apply: bool = True,
    repeat_count: int = 3,
    variations: Mapping[str, Sequence[str]] = COLUMN_WORDS,
    seed: int = 42,
    null_literal: str | None = None,
    observation: Observation | str | None = None,
) -> DataFrame:
    """``(ex_id, copy_id, prompt)``: augmented where switched on, input line optional.

    ``observation`` gets the row counts before and after augmentation with the
    first job that uses the result.
    """
    varied = augment(_keyed(df), apply, repeat_count, variations, seed, null_literal)
    if observation is not None:
        varied = observe_report(varied, observation)
    return prompt_optional_input(varied).select("ex_id", "copy_id", "prompt")


def encode(
    prompts: DataFrame,
    max_length: int,
    vocab: DataFrame | None = None,
    tokenizer_json: str | None = None,
) -> DataFrame:
    """Ids of the prompts, by a word vocabulary table or by a serialized tokenizer."""
    if (vocab is None) == (tokenizer_json is None):
        raise ValueError("give either a vocabulary or a tokenizer")
    if vocab is not None:
        return encode_words(prompts, vocab, max_length).drop("prompt")
    return tokenize_batches(prompts, tokenizer_json, max_length)


def prepare_v1(
    df: DataFrame,
    vocab: DataFrame | None = None,
    tokenizer_json: str | None = None,
    max_length: int = 512,
    repeat_count: int = 3,
    words: Sequence[str] = SLOT_WORDS,
    seed: int = 42,
    pad_id: int = PAD_ID,
) -> DataFrame:
    """``(ex_id, copy_id, input_ids, attention_mask)``; labels are left to the collator."""
    ids = encode(render_v1(df, repeat_count, words, seed), max_length, vocab, tokenizer_json)
    return finish_ids(ids, max_length, pad_id, labels=False)


def prepare_v2(
    df: DataFrame,
    vocab: DataFrame | None = None,
    tokenizer_json: str | None = None,
    max_length: int = 512,
    apply: bool = True,
    repeat_count: int = 3,
    variations: Mapping[str, Sequence[str]] = COLUMN_WORDS,
    seed: int = 42,
    null_literal: str | None = None,
    pad_id: int | None = PAD_ID,
    eos_id: int | None = None,
    observation: Observation | str | None = None,
) -> DataFrame:
    """``(ex_id, copy_id, input_ids, attention_mask, labels)``."""
    prompts = render_v2(df, apply, repeat_count, variations, seed, null_literal, observation)
    return finish_ids(encode(prompts, max_length, vocab, tokenizer_json), max_length, pad_id, eos_id)
