"""Subword ids by greedy longest match, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomfeed.functions.arrays import words
from loomfeed.functions.text import as_column
from loomfeed.operators.vocab import _BUCKET_WORDS, _ENTRY_OVERHEAD, MAX_INLINE_BYTES, UNK_ID, _bucket, _lookup_table

# Characters of the longest piece; longer words of a vocabulary are not matched.
LONGEST_PIECE = 16
_LENGTHS = 64  # an id and a length share a number


def add_characters(vocab: DataFrame, df: DataFrame, col: str = "prompt") -> DataFrame:
    """``vocab`` and, with the next ids, every single character of ``col`` it lacks, in order.

    With them no word is unknown. A text gives each of its characters once, so at
    most the characters of the script are counted per task.
    """
    letters = F.array_distinct(F.split(F.regexp_replace(as_column(col), r"[ \n\t\r]+", ""), ""))
    seen = df.select(F.explode(letters).alias("tok")).filter("tok <> ''").distinct()
    new = seen.join(vocab.select("tok"), "tok", "left_anti")
    last = vocab.agg(F.coalesce(F.max("id"), F.lit(-1))).scalar()
    # one row per character
    numbered = new.select("tok", (F.row_number().over(Window.orderBy("tok")) + last).cast("int").alias("id"))
    return vocab.select("tok", "id").unionByName(numbered)


def encode_pieces(
    df: DataFrame,
    vocab: DataFrame,
    max_length: int,
    text: str = "prompt",
    unk_id: int = UNK_ID,
    out: str = "ids",
    longest: int = LONGEST_PIECE,
    max_inline_bytes: int = MAX_INLINE_BYTES,
) -> DataFrame:
    """The first ``max_length`` piece ids of ``text``.

    Each word is cut from its beginning into the longest pieces of ``vocab`` that
    fit; a character that begins no piece is ``unk_id``. The vocabulary is one
    constant table inside the projection, tried by piece length, so nothing is
    moved or exploded, and it works on streams. It is measured first and refused
    beyond ``max_inline_bytes``, about 400,000 pieces. Null texts have an empty list.
    """
    pieces = vocab.filter(F.length("tok").between(1, longest)).select("tok", "id")
    rows, size, lengths = pieces.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("tok")), F.lit(0)), F.collect_set(F.length("tok"))
    ).first()
    if size + rows * _ENTRY_OVERHEAD > max_inline_bytes:
        raise ValueError(f"the vocabulary has more than {max_inline_bytes} bytes: use a smaller one or raise the limit")
    buckets = max(1, rows // _BUCKET_WORDS)
    # lengths to try by the characters left: a length that can't fit costs as much as one that does
    most = max(lengths, default=0)
    by_room = F.array(*[
        F.array(*[F.lit(n) for n in sorted(lengths, reverse=True) if n <= room]).cast("array<int>")
        for room in range(most + 1)
    ])

    def piece_at(word: Column, at: Column) -> Column:
        """Id and length of the longest piece at a place, as one number."""

        def try_length(found: Column, n: Column) -> Column:
            part = F.substring(word, at, n)
            fits = F.try_element_at(F.get(F.col("_table"), _bucket(part, buckets)), part)
            return F.coalesce(found, fits.cast("long") * _LENGTHS + n)

        tried = F.get(by_room, F.least(F.length(word) - at + 1, F.lit(most)))
        return F.coalesce(F.aggregate(tried, F.lit(None).cast("long"), try_length), F.lit(unk_id * _LENGTHS + 1))

    def cut(word: Column) -> Column:
        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("ids"))

        def go_on(done: Column, at: Column) -> Column:
            # the piece is bound by a one-element list, so that it is looked for once
            taken = F.transform(
                F.array(piece_at(word, at)),
                lambda p: F.struct(
                    (at + p % _LENGTHS).cast("int").alias("at"),
                    F.concat(done["ids"], F.array(F.shiftright(p, 6).cast("int"))).alias("ids"),
                ),
            )
            here = (done["at"] == at) & (F.size(done["ids"]) < max_length)
            return F.when(here, F.get(taken, F.lit(0))).otherwise(done)

        return F.aggregate(F.sequence(F.lit(1), F.length(word)), start, go_on, lambda done: done["ids"])

    # what lies behind can't be among the first ids
    listed = F.transform(words(as_column(text), max_length), lambda w: F.substring(w, 1, max_length * longest))

    def ids_of(word: Column) -> Column:
        """A word that is a piece as a whole, as most are, needs no loop over its places."""
        bound = F.transform(
            F.array(F.try_element_at(F.get(F.col("_whole"), _bucket(word, buckets)), word)),
            lambda known: F.when(known.isNull(), cut(word)).otherwise(F.array(known)),
        )
        return F.get(bound, F.lit(0))

    ids = F.slice(F.flatten(F.transform("_words", ids_of)), 1, max_length)
    # the table once for each place it is used in, or it would stay a column
    table = _lookup_table(pieces, buckets)
    return (
        df.withColumn("_words", listed)
        .withColumn("_table", table.scalar())
        .withColumn("_whole", table.scalar())
        .withColumn(out, ids)
        .drop("_words", "_table", "_whole")
    )
