from loomfeed.sources.csv import NA_WORDS, ingest_examples, normalize_missing, read_examples
from loomfeed.sources.planned import read_planned, write_planned
from loomfeed.sources.shards import ShardRows, read_shards, write_shards
from loomfeed.sources.sinks import write_examples

__all__ = [
    "NA_WORDS", "ShardRows", "ingest_examples", "normalize_missing", "read_examples", "read_planned", "read_shards",
    "write_examples", "write_planned", "write_shards",
]
