"""Word-level vocabulary: counting words, and text to ids."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.functions.arrays import words
from loomfeed.functions.text import as_column, quoted
from loomfeed.session import checkpoint

# Special words, whose ids are their places in this list.
SPECIALS = ("<pad>", "<bos>", "<eos>", "<unk>")
PAD_ID, BOS_ID, EOS_ID, UNK_ID = range(4)

# A vocabulary of up to this many bytes travels inside the plan.
MAX_INLINE_BYTES = 32 * 1024 * 1024
_ENTRY_OVERHEAD = 64
# Words per bucket of the lookup table: few enough to search, enough to keep it small.
_BUCKET_WORDS = 4
# Longer words are not put into a constant table.
LONGEST_INLINE = 256
# At most this many words can each make up 1/FREQUENT_WORDS of a text.
FREQUENT_WORDS = 100_000
# A place in a list and an id, which may be negative, share a number.
_PLACE = 1 << 32


def count_words(df: DataFrame, col: str = "prompt", specials: Sequence[str] = SPECIALS) -> DataFrame:
    """``(tok, n)``: how often each word occurs, specials left out.

    Counts combine map-side, so a very frequent word costs one row per task.
    Counts of batches can be stored and merged.
    """
    return (
        df.select(F.explode(words(as_column(col))).alias("tok"))
        .filter(~F.col("tok").isin(*specials))
        .groupBy("tok")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge_counts(*counts: DataFrame) -> DataFrame:
    """The counts of all batches together."""
    every = counts[0].select("tok", "n")
    for more in counts[1:]:
        every = every.unionByName(more.select("tok", "n"))
    return every.groupBy("tok").agg(F.sum("n").alias("n"))


def _most_frequent(counted: DataFrame, size: int, first: int | Column) -> DataFrame:
    """``(tok, id)`` of the ``size`` most frequent words, ties by word, ids from ``first``.

    The count of the last word to make it is found first, from the histogram of
    counts; only words at least that frequent reach the final top-k.
    """
    # few rows: n words have at most sqrt(2n) distinct counts
    histogram = counted.groupBy("n").agg(F.count(F.lit(1)).alias("m"))
    from_top = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    least = (
        histogram.select("n", F.sum("m").over(from_top).alias("reached"))
        .filter(F.col("reached") >= size)
        .agg(F.max("n").alias("n"))
    )
    by_rank = [F.desc("n"), F.asc("tok")]
    top = (
        counted.filter(F.col("n") >= F.coalesce(least.scalar(), F.lit(0)))
        .orderBy(*by_rank)
        .limit(size)
    )
    return top.select("tok", (F.row_number().over(Window.orderBy(*by_rank)) + (first - 1)).cast("int").alias("id"))


def vocab_of_counts(counted: DataFrame, size: int = 32_000, specials: Sequence[str] = SPECIALS) -> DataFrame:
    """``(tok, id)``: the specials, then the ``size`` most frequent words, ties by word."""
    fixed = counted.sparkSession.createDataFrame(
        [(tok, i) for i, tok in enumerate(specials)], "tok string, id int"
    )
    return fixed.unionByName(_most_frequent(counted, size, len(specials)))


def build_vocab(
    df: DataFrame, col: str = "prompt", size: int = 32_000, specials: Sequence[str] = SPECIALS
) -> DataFrame:
    """The vocabulary of the words of ``col``: :func:`vocab_of_counts` of :func:`count_words`."""
    return vocab_of_counts(count_words(df, col, specials), size, specials)


def grow_vocab(vocab: DataFrame, counted: DataFrame, size: int = 32_000) -> DataFrame:
    """``vocab`` with the most frequent words it lacks, up to ``size`` entries in all.

    Words keep their ids, also where their counts have fallen behind; new words
    take the ids after the last one, most frequent first, ties by word. Give a
    stored vocabulary and stored counts: both are read more than once.
    """
    held, last = vocab.agg(F.count(F.lit(1)), F.coalesce(F.max("id"), F.lit(-1))).first()
    if held >= size:
        return vocab.select("tok", "id")
    new = counted.join(vocab.select("tok"), "tok", "left_anti")
    return vocab.select("tok", "id").unionByName(_most_frequent(new, size - held, last + 1))


def _bucket(tok: Column, buckets: int) -> Column:
    return F.pmod(F.hash(tok), F.lit(buckets))


def _lookup_table(vocab: DataFrame, buckets: int) -> DataFrame:
    """One row: an array of small word-to-id maps, placed by the word's hash."""
    entries = vocab.select(_bucket(F.col("tok"), buckets).alias("_b"), F.struct("tok", "id").alias("_e"))
    # one null entry per bucket, so that an empty bucket keeps its place
    every = vocab.sparkSession.range(buckets).select(
        F.col("id").cast("int").alias("_b"), F.lit(None).cast("struct<tok:string,id:int>").alias("_e")
    )
    placed = entries.unionByName(every).groupBy("_b").agg(F.collect_list("_e").alias("_e"))
    return placed.agg(F.sort_array(F.collect_list(F.struct("_b", "_e"))).alias("_all")).select(
        F.transform("_all", lambda p: F.map_from_entries(p["_e"])).alias("_lookup")
    )


def _looked_up(df, table_words, buckets, words_col, out, cell):
    """Apply ``cell(word, place, id or null)`` to every word, ids from a constant table.

    Words, table and result are three projections whose columns are each used
    once, so the optimizer merges them and the table becomes a constant inside
    the lookup. It must not stay a column: every row would carry a copy.
    """
    result = F.transform(
        "_words",
        lambda tok, at: cell(tok, at, F.try_element_at(F.get(F.col("_table"), _bucket(tok, buckets)), tok)),
    )
    return (
        df.withColumn("_words", words_col)
        .withColumn("_table", _lookup_table(table_words, buckets).scalar())
        .withColumn(out, result)
        .drop("_words", "_table")
    )


def _encode_inline(df, vocab, rows, words_col, unk_id, out):
    buckets = max(1, rows // _BUCKET_WORDS)
    return _looked_up(df, vocab, buckets, words_col, out, lambda tok, at, found: F.coalesce(found, F.lit(unk_id)))


def _frequent(rows, vocab, unk_id, share):
    """Id, or ``unk_id``, of each short word that makes up at least ``1/share`` of all words.

    There are at most ``share`` such words of at most ``LONGEST_INLINE`` bytes,
    which bounds the constant table. A longer one goes the way of rare words.
    """
    counted = rows.select(F.explode("_words").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    # from the lists, so that the words are not exploded and counted once more
    total = rows.agg(F.sum(F.size("_words"))).scalar()
    often = counted.filter((F.col("n") * share >= total) & (F.octet_length("tok") <= LONGEST_INLINE))
    return often.join(vocab, "tok", "left").select("tok", F.coalesce("id", F.lit(unk_id)).alias("id"))


def _encode_shuffled(df, vocab, words_col, unk_id, out, share):
    """Frequent words by a constant table, the others by a join.

    The text is split once; the rows are checkpointed with their words and a row
    number, and rare words come back over that number, so keys of the table play
    no part. The join sees only words that are rare in this text, known or not,
    so none of its keys is hot, and most of the text never leaves its place.
    """
    rows = checkpoint(df.withColumn("_words", words_col).withColumn("_row", F.monotonically_increasing_id()))
    frequent = checkpoint(_frequent(rows, vocab, unk_id, share))
    buckets = max(1, frequent.count() // _BUCKET_WORDS)
    # the words themselves go no further than the join; rows move with ids alone
    listed = F.col("_words")
    known = _looked_up(
        rows.select(*[F.col(quoted(c)) for c in df.columns], "_row", listed.alias("_list")),
        frequent, buckets, F.col("_list"), "_known", lambda tok, at, found: found,
    ).drop("_list")
    cells = _looked_up(
        rows.select("_row", listed.alias("_list")), frequent, buckets, F.col("_list"), "_cells",
        lambda tok, at, found: F.when(found.isNull(), F.struct(at.alias("at"), tok.alias("tok"))),
    )
    rare = cells.select("_row", F.explode(F.array_compact("_cells")).alias("_c"))
    # size estimates do not see that exploding multiplies rows: never broadcast here
    found = rare.select("_row", "_c.at", "_c.tok").join(vocab.hint("merge"), "tok")
    # at most max_length entries per row, each place and id as one number
    entries = found.select("_row", (F.col("at").cast("long") * _PLACE + F.col("id")).alias("_e"))

    def place_and_id(e: Column) -> Column:
        at = F.shiftright(e + _PLACE // 2, 32)
        return F.struct(at.cast("int").alias("at"), (e - at * _PLACE).cast("int").alias("id"))

    grouped = entries.groupBy("_row").agg(
        F.map_from_entries(F.transform(F.collect_set("_e"), place_and_id)).alias("_found")
    )
    ids = F.transform(
        "_known", lambda i, at: F.coalesce(i, F.try_element_at(F.col("_found"), at), F.lit(unk_id))
    )
    joined = known.join(grouped.hint("merge"), "_row", "left")
    return joined.select(*[F.col(quoted(c)) for c in df.columns], ids.alias(out))


def encode_words(
    df: DataFrame,
    vocab: DataFrame,
    max_length: int,
    text: str = "prompt",
    unk_id: int = UNK_ID,
    out: str = "ids",
    max_inline_bytes: int = MAX_INLINE_BYTES,
    frequent_words: int = FREQUENT_WORDS,
    bos_id: int | None = None,
    eos_id: int | None = None,
) -> DataFrame:
    """Ids of the first words of ``text``, ``unk_id`` for unknown ones, at most ``max_length``.

    ``bos_id`` and ``eos_id`` are put around the words and count in ``max_length``.
    The vocabulary is measured first. Up to ``max_inline_bytes`` it becomes one
    constant lookup table inside the projection, so the text is neither moved nor
    exploded. With a bigger one that is done for the frequent words of the text
    only; the others are joined by shuffle, which a stream can't do. Both ways
    give the same rows. Give a stored or checkpointed vocabulary: it is read more
    than once.
    """
    around = [i for i in (bos_id, eos_id) if i is not None]
    if len(around) > max_length:
        raise ValueError(f"max_length {max_length} leaves no room for {len(around)} special ids")
    words_col = words(as_column(text), max_length - len(around))
    rows, size = vocab.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("tok")), F.lit(0))
    ).first()
    if size + rows * _ENTRY_OVERHEAD <= max_inline_bytes:
        encoded = _encode_inline(df, vocab, rows, words_col, unk_id, out)
    elif df.isStreaming:
        raise ValueError(
            f"the vocabulary has more than {max_inline_bytes} bytes, too many to encode a stream:"
            " raise max_inline_bytes or use a smaller vocabulary"
        )
    else:
        encoded = _encode_shuffled(df, vocab, words_col, unk_id, out, frequent_words)
    if not around:
        return encoded
    parts = [F.array(F.lit(bos_id))] if bos_id is not None else []
    parts.append(F.col(out))
    parts += [F.array(F.lit(eos_id))] if eos_id is not None else []
    return encoded.withColumn(out, F.concat(*parts))


def word_level_json(vocab: DataFrame, unk: str = SPECIALS[UNK_ID]) -> str:
    """``vocab`` as a serialized tokenizer for :func:`tokenize_batches`.

    It is measured before it is collected, and refused beyond ``MAX_INLINE_BYTES``.
    """
    rows, size = vocab.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("tok")), F.lit(0))).first()
    if size + rows * _ENTRY_OVERHEAD > MAX_INLINE_BYTES:
        raise ValueError(f"the vocabulary has more than {MAX_INLINE_BYTES} bytes")
    ids = {row["tok"]: row["id"] for row in vocab.collect()}
    return json.dumps(
        {
            "version": "1.0",
            "truncation": None,
            "padding": None,
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": {
                "type": "Split",
                "pattern": {"Regex": "[ \n\t\r]+"},
                "behavior": "Removed",
                "invert": False,
            },
            "post_processor": None,
            "decoder": None,
            "model": {"type": "WordLevel", "vocab": ids, "unk_token": unk},
        },
        ensure_ascii=False,
    )
