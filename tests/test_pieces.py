import random

import pytest

from loomfeed.operators import (
    add_characters,
    build_vocab,
    count_words,
    encode_pieces,
    grow_vocab,
    merge_counts,
    vocab_of_counts,
)
from loomfeed.session import checkpoint
from tests.conftest import node_names, plan_nodes


def greedy(text, vocab, longest, length):
    out = []
    for word in (text or "").split():
        at = 0
        while at < len(word):
            n = next((n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in vocab), None)
            out.append(vocab[word[at : at + n]] if n else 3)
            at += n or 1
    return out[:length]


@pytest.mark.parametrize("length", [1, 7, 500])
def test_pieces_equal_a_plain_loop(spark, length):
    rng = random.Random(length)
    letters = "abcé😀"
    tokens = {"".join(rng.choices(letters[:4], k=rng.randrange(1, 7))) for _ in range(60)} - {"c"}
    vocab = {t: i + 4 for i, t in enumerate(sorted(tokens))}
    texts = [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(20)) for _ in range(40)]
    texts += [None, "", " \t\n ", "ab" * 5000, "z" * 3000 + " ab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    table = checkpoint(spark.createDataFrame(list(vocab.items()), "tok string, id int"))
    for longest in (3, 16):
        got = {r["doc_id"]: r["ids"] for r in encode_pieces(docs, table, length, "text", longest=longest).collect()}
        for i, text in enumerate(texts):
            assert got[i] == greedy(text, vocab, longest, length)


def test_whole_words_are_looked_up_before_any_loop(spark):
    docs = spark.createDataFrame([("ab abc a zab 😀b",)], "text string")
    table = checkpoint(spark.createDataFrame([("ab", 4), ("abc", 5), ("b", 6)], "tok string, id int"))
    encoded = encode_pieces(docs, table, 20, "text")
    assert encoded.first()["ids"] == [4, 5, 3, 3, 4, 3, 6]
    assert "_whole" in encoded._jdf.queryExecution().analyzed().toString()
    assert not any("_whole" in output or "_table" in output for _, output in plan_nodes(encoded))
    none = checkpoint(spark.createDataFrame([], "tok string, id int"))
    assert encode_pieces(docs, none, 20, "text").first()["ids"] == [3] * 11


def test_characters_make_every_word_known(spark):
    docs = spark.createDataFrame([("the cat é",), ("then 猫\tsat",), (None,), ("",)], "text string")
    vocab = checkpoint(build_vocab(docs, "text", 2))
    whole = checkpoint(add_characters(vocab, docs, "text"))
    rows = {r["tok"]: r["id"] for r in whole.collect()}
    assert [t for t in rows if rows[t] >= 6] == sorted(set("thecaténs猫") - set(rows) | {t for t in rows if rows[t] >= 6})
    assert sorted(rows.values()) == list(range(len(rows)))
    ids = [r["ids"] for r in encode_pieces(docs, whole, 50, "text").collect()]
    assert all(3 not in i for i in ids if i)


def test_encoding_moves_nothing_and_measures_the_vocabulary(spark):
    docs = spark.createDataFrame([("a b",)], "text string")
    vocab = checkpoint(build_vocab(docs, "text", 2))
    encoded = encode_pieces(docs, vocab, 5, "text")
    assert not node_names(encoded) & {"Join", "Aggregate", "Generate", "ArrowEvalPython", "MapInArrow"}
    assert "_table" not in encoded._jdf.queryExecution().executedPlan().output().mkString(" ")
    with pytest.raises(ValueError, match="more than 10 bytes"):
        encode_pieces(docs, vocab, 5, "text", max_inline_bytes=10)


def test_counts_of_batches_equal_one_pass_and_ids_stay(spark):
    rng = random.Random(4)
    texts = [(" ".join(f"w{int(rng.paretovariate(1))}" for _ in range(50)),) for _ in range(40)]
    first, second, whole = (spark.createDataFrame(t, "prompt string") for t in (texts[:15], texts[15:], texts))
    counts = [checkpoint(count_words(df)) for df in (first, second)]
    merged = checkpoint(merge_counts(*counts))
    assert sorted(merged.collect()) == sorted(count_words(whole).collect())
    assert sorted(vocab_of_counts(merged, 30).collect()) == sorted(build_vocab(whole, size=30).collect())
    old = checkpoint(vocab_of_counts(counts[0], 20))
    new = checkpoint(grow_vocab(old, merged, 60))
    before, after = ({r["tok"]: r["id"] for r in v.collect()} for v in (old, new))
    assert {t: after[t] for t in before} == before
    assert sorted(after.values()) == list(range(60))
    n = {r["tok"]: r["n"] for r in merged.collect()}
    added = sorted((t for t in after if t not in before), key=after.get)
    assert added == sorted((t for t in n if t not in before), key=lambda t: (-n[t], t))[: len(added)]
    assert grow_vocab(new, merged, 60).count() == grow_vocab(new, merged, 5).count() == 60
    empty = spark.createDataFrame([], "tok string, n long")
    assert grow_vocab(old, empty, 100).count() == old.count()
