from loomfeed.operators.augment import augment, renumber, replicate, vary_columns, vary_slots
from loomfeed.operators.checks import require_columns
from loomfeed.operators.feed import assign_batches, collate, epochs, split, split_by_hash
from loomfeed.operators.keys import content_keys, row_keys
from loomfeed.operators.permutation import from_step, keyed_epochs, place_of, row_at
from loomfeed.operators.pieces import add_characters, encode_pieces
from loomfeed.operators.prompts import prompt_full, prompt_optional_input
from loomfeed.operators.report import augment_report, observe_report
from loomfeed.operators.tokens import finish_ids, tokenize_batches
from loomfeed.operators.vocab import (
    build_vocab,
    count_words,
    encode_words,
    grow_vocab,
    merge_counts,
    vocab_of_counts,
    word_level_json,
)

__all__ = [
    "add_characters", "assign_batches", "augment", "augment_report", "build_vocab", "collate", "content_keys",
    "count_words", "encode_pieces", "encode_words", "epochs", "finish_ids", "from_step", "grow_vocab",
    "keyed_epochs", "merge_counts", "observe_report", "place_of", "prompt_full", "prompt_optional_input",
    "renumber", "replicate", "require_columns", "row_at", "row_keys", "split", "split_by_hash",
    "tokenize_batches", "vary_columns", "vary_slots", "vocab_of_counts", "word_level_json",
]
