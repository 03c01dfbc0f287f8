"""Token ids: encoding with a ready tokenizer, then cutting, padding and labelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomfeed.functions import arrays

MAX_TOKENIZER_BYTES = 256 * 1024 * 1024


def tokenize_batches(
    df: DataFrame,
    tokenizer_json: str,
    max_length: int,
    text: str = "prompt",
    out: str = "ids",
    batch_rows: int = 1000,
) -> DataFrame:
    """Encode ``text`` with any serialized tokenizer, over Arrow batches.

    ``text`` is replaced by the unpadded ids, cut to ``max_length`` by the
    tokenizer itself (its own special ids count); padding, mask and labels are
    left to :func:`finish_ids`, so only real tokens come back from Python. The
    tokenizer is broadcast and built once per task.
    """
    if len(tokenizer_json.encode()) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"tokenizer is larger than {MAX_TOKENIZER_BYTES} bytes")
    shared = df.sparkSession.sparkContext.broadcast(tokenizer_json)
    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType()))])
    names = [f.name for f in kept]

    # closed over by value, so that workers need no copy of this module
    def encode(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import pyarrow as pa
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(shared.value)
        tokenizer.no_padding()
        tokenizer.enable_truncation(max_length)
        # without offsets where the library can
        encode_batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                prompts = [t or "" for t in part.column(text).to_pylist()]
                ids = [e.ids for e in encode_batch(prompts)]
                offsets = np.zeros(len(ids) + 1, dtype=np.int32)
                np.cumsum([len(i) for i in ids], out=offsets[1:])
                flat = np.concatenate([np.asarray(i, dtype=np.int32) for i in ids])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                columns = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, lists], names=[*names, out])

    return df.mapInArrow(encode, schema)


def pad_token(pad_id: int | None, eos_id: int | None) -> int:
    """``pad_id``, or ``eos_id`` for a tokenizer without one."""
    if pad_id is not None:
        return pad_id
    if eos_id is None:
        raise ValueError("need a pad id or an end-of-sequence id")
    return eos_id


def finish_ids(
    df: DataFrame,
    max_length: int,
    pad_id: int | None = None,
    eos_id: int | None = None,
    padding: str = "max_length",
    side: str = "right",
    ids: str = "ids",
    labels: bool = True,
    batch: Sequence[str] = ("epoch", "rank", "micro"),
) -> DataFrame:
    """Replace ``ids`` by ``input_ids``, ``attention_mask`` and ``labels``.

    ``padding="max_length"`` fills up to ``max_length``; ``"longest"`` up to the
    longest row of its ``batch``, the small fixed-size groups made by
    :func:`assign_batches`. Labels ignore the pad id wherever it stands, so with
    the end-of-sequence id as padding a real one is ignored too.
    """
    pad_with = pad_token(pad_id, eos_id)
    df = df.withColumn(ids, arrays.truncate(F.col(ids), max_length))
    if padding == "max_length":
        length = F.lit(max_length)
    elif padding == "longest":
        length = F.col("_longest")
        df = df.withColumn("_longest", F.max(F.size(ids)).over(Window.partitionBy(*batch)))
    else:
        raise ValueError(f"padding must be 'max_length' or 'longest', not {padding!r}")
    cols = {
        "input_ids": arrays.pad(F.col(ids), length, pad_with, side),
        "attention_mask": arrays.attention_mask(F.col(ids), length, side),
    }
    if labels:
        cols["labels"] = arrays.padded_labels(F.col(ids), length, pad_with, side)
    return df.withColumns(cols).drop(ids, "_longest")
