import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomfeed.functions import arrays
from loomfeed.operators.augment import replicate
from loomfeed.operators.tokens import finish_ids, tokenize_batches
from loomfeed.operators.vocab import SPECIALS, UNK_ID, _frequent, build_vocab, encode_words, word_level_json
from loomfeed.plans.catalog import as_padded_text, as_text
from loomfeed.session import checkpoint
from tests.conftest import node_names, plan_nodes

TEXTS = [
    "b a a c",
    "  a \n\n b\tc\r\nd ",
    "",
    " \n ",
    "zz yy",
    "a " * 50,
    "é 요약 a",
    "<pad> a <unk>",
    None,
]


@pytest.fixture
def table(spark):
    return replicate(spark.createDataFrame(list(enumerate(TEXTS)), "ex_id long, prompt string"), 1)


@pytest.fixture
def vocab(table):
    return checkpoint(build_vocab(table, size=4))


def vocab_dict(df):
    return {r.tok: r.id for r in df.collect()}


def python_vocab(texts, size):
    counts = Counter(w for t in texts for w in (t or "").split() if w not in SPECIALS)
    top = sorted(counts, key=lambda w: (-counts[w], w))[:size]
    return {w: i for i, w in enumerate([*SPECIALS, *top])}


@pytest.mark.parametrize("size", [0, 1, 2, 3, 4, 5, 100])
def test_build_vocab(table, size):
    assert vocab_dict(build_vocab(table, size=size)) == python_vocab(TEXTS, size)


def test_build_vocab_with_many_ties(spark):
    words = [f"w{i:03d}" for i in range(200)] * 2 + ["top"] * 9 + ["low"]
    df = spark.createDataFrame([(w,) for w in words], "prompt string").repartition(6)
    for size in (1, 2, 100, 201, 202):
        assert vocab_dict(build_vocab(df, size=size)) == python_vocab(words, size)


def expected_ids(ids, length):
    return {i: [ids.get(w, UNK_ID) for w in (t or "").split()][:length] for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("length", [1, 3, 8, 60])
@pytest.mark.parametrize("inline, frequent", [(1 << 20, 1), (0, 1), (0, 4), (0, 1000)])
def test_encode_words(table, vocab, length, inline, frequent):
    got = encode_words(table, vocab, length, max_inline_bytes=inline, frequent_words=frequent)
    assert {r.ex_id: r.ids for r in got.collect()} == expected_ids(vocab_dict(vocab), length)
    assert got.columns == ["ex_id", "prompt", "copy_id", "ids"]


@pytest.mark.parametrize("frequent", [1, 3, 1000])
def test_encode_words_with_equal_rows_under_one_key(table, vocab, frequent):
    twice = table.unionByName(table)
    got = encode_words(twice, vocab, 8, max_inline_bytes=0, frequent_words=frequent)
    want = expected_ids(vocab_dict(vocab), 8)
    rows = got.collect()
    assert len(rows) == 2 * len(want) and all(r.ids == want[r.ex_id] for r in rows)


def test_only_rare_words_are_joined(spark, table, vocab):
    """A word that makes up a third of the text is looked up, known or not."""
    for hot in ("a", "unknown"):
        df = replicate(spark.createDataFrame([(1, f"{hot} b c " * 100), (2, "d e")], "ex_id long, prompt string"), 1)
        rows = df.withColumn("_words", arrays.words(F.col("prompt"), 1000))
        often = {r.tok: r.id for r in _frequent(rows, vocab, UNK_ID, 4).collect()}
        ids = vocab_dict(vocab)
        assert often == {w: ids.get(w, UNK_ID) for w in (hot, "b", "c")}


@pytest.mark.parametrize("inline", [1 << 20, 0])
def test_encode_words_never_looks_at_keys(spark, vocab, inline):
    rows = [("k", "a b"), ("k", "c zz a"), (None, "b b"), (None, ""), ("k", "a b"), ("long", "x" * 400 + " a")]
    df = spark.createDataFrame(rows, "ex_id string, prompt string")
    got = encode_words(df, vocab, 8, max_inline_bytes=inline, frequent_words=2, bos_id=1, eos_id=2)
    ids = vocab_dict(vocab)
    want = sorted((k or "", t, [1, *[ids.get(w, UNK_ID) for w in t.split()], 2]) for k, t in rows)
    assert sorted((r.ex_id or "", r.prompt, r.ids) for r in got.collect()) == want
    cut = encode_words(df, vocab, 3, max_inline_bytes=inline, frequent_words=2, bos_id=1, eos_id=2)
    assert max(len(r.ids) for r in cut.collect()) == 3
    with pytest.raises(ValueError, match="no room"):
        encode_words(df, vocab, 1, bos_id=1, eos_id=2)


def test_streams_encode_inline_or_fail_before_any_job(spark, vocab, tmp_path):
    spark.createDataFrame([("a b zz",)], "prompt string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("prompt string").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="stream"):
        encode_words(stream, vocab, 8, max_inline_bytes=0)
    out = encode_words(stream, vocab, 8)
    query = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    query.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    ids = vocab_dict(vocab)
    assert spark.read.parquet(str(tmp_path / "out")).first().ids == [ids.get(w, UNK_ID) for w in ("a", "b", "zz")]


def test_tokenizer_equals_relational(table, vocab):
    for batch_rows in (1, 4, 1000):
        got = tokenize_batches(table, word_level_json(vocab), 8, batch_rows=batch_rows)
        assert got.columns == ["ex_id", "copy_id", "ids"]
        assert {r.ex_id: r.ids for r in got.collect()} == expected_ids(vocab_dict(vocab), 8)


def test_tokenizer_with_its_own_special_tokens(table, vocab):
    model = json.loads(word_level_json(vocab))
    model["post_processor"] = {
        "type": "TemplateProcessing",
        "single": [{"SpecialToken": {"id": "<bos>", "type_id": 0}}, {"Sequence": {"id": "A", "type_id": 0}}],
        "pair": [{"Sequence": {"id": "A", "type_id": 0}}, {"Sequence": {"id": "B", "type_id": 0}}],
        "special_tokens": {"<bos>": {"id": "<bos>", "ids": [1], "tokens": ["<bos>"]}},
    }
    got = {r.ex_id: r.ids for r in tokenize_batches(table, json.dumps(model), 8).collect()}
    want = {i: [1, *ids] for i, ids in expected_ids(vocab_dict(vocab), 7).items()}
    assert got == want


def test_inline_vocabulary_never_becomes_a_column(table, vocab):
    """A table carried as a column would be copied into every row."""
    varied = table.withColumn("prompt", F.concat_ws("\n", "prompt", F.md5(F.col("ex_id").cast("string"))))
    for df in (table, varied):
        out = finish_ids(encode_words(df, vocab, 8).drop("prompt"), 8, 0)
        assert not any("_table" in output for _, output in plan_nodes(out))
        assert not node_names(out) & {"Join", "Aggregate", "Window"}


@pytest.fixture
def id_rows(spark):
    rows = [(0, [5, 6]), (1, []), (2, list(range(4, 14))), (3, [7, 2, 0]), (4, [9] * 5)]
    return spark.createDataFrame(rows, "ex_id long, ids array<int>")


@pytest.mark.parametrize("side", ["left", "right"])
@pytest.mark.parametrize("pad_id, eos_id, pad", [(0, None, 0), (None, 2, 2), (0, 2, 0)])
def test_finish_ids(id_rows, side, pad_id, eos_id, pad):
    before = {r.ex_id: r.ids[:5] for r in id_rows.collect()}
    out = finish_ids(id_rows, 5, pad_id, eos_id, side=side)
    assert out.columns == ["ex_id", "input_ids", "attention_mask", "labels"]
    for r in out.collect():
        ids, fill = before[r.ex_id], 5 - len(before[r.ex_id])
        joined = (lambda a, b: a + b) if side == "right" else (lambda a, b: b + a)
        assert r.input_ids == joined(ids, [pad] * fill)
        assert r.attention_mask == joined([1] * len(ids), [0] * fill)
        assert r.labels == [-100 if i == pad else i for i in r.input_ids]


def test_labels_agree_with_masking_the_padded_ids(id_rows):
    short = arrays.truncate(F.col("ids"), 5)
    both = id_rows.select(
        arrays.padded_labels(short, 5, 2).alias("a"), arrays.mask_labels(arrays.pad(short, 5, 2), 2).alias("b")
    )
    assert all(r.a == r.b for r in both.collect())


def test_pad_longest(id_rows):
    batched = id_rows.withColumn("micro", (F.col("ex_id") / 2).cast("int"))
    out = finish_ids(batched, 6, 0, padding="longest", batch=["micro"])
    sizes = {r.ex_id: len(r.input_ids) for r in out.collect()}
    assert sizes == {0: 2, 1: 2, 2: 6, 3: 6, 4: 5}
    assert all(len(r.input_ids) == len(r.labels) == len(r.attention_mask) for r in out.collect())


def test_finish_ids_arguments(id_rows):
    with pytest.raises(ValueError, match="pad id"):
        finish_ids(id_rows, 5)
    with pytest.raises(ValueError, match="padding"):
        finish_ids(id_rows, 5, 0, padding="none")
    with pytest.raises(ValueError, match="side"):
        finish_ids(id_rows, 5, 0, side="top")
    assert finish_ids(id_rows, 5, 0, labels=False).columns == ["ex_id", "input_ids", "attention_mask"]


def test_words_limit_equals_slice_of_all(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    for n in range(6):
        got = df.select("t", arrays.words(F.col("t"), n).alias("cut"), arrays.words(F.col("t")).alias("all"))
        for r in got.collect():
            assert r["all"] == r.t.split() and r.cut == r.t.split()[:n]


def test_text_of_padded_arrays_equals_the_plain_join(spark):
    rows = [
        ("right", 2, [5, 6, 0, 0, 0]), ("right", 0, [0, 0, 0]), ("right", 3, [7, 0, 7]), ("right", 0, []),
        ("right", 1, [4, 0, 9, 0]), ("right", 1, [4, 0, None, 0]), ("right", 1, [4, 0, None]), ("right", 3, [0, 0, 1, 0, 0]),
        ("right", 1, [2, 2, 2]), ("right", None, None), ("left", 2, [-100, -100, 5, 6]), ("left", 0, [-100]),
        ("left", 1, [0, 3, 0, 8]), ("left", 3, [1, 2, 3]), ("left", 0, []), ("left", 1, [None, 0, 1]), ("left", None, None),
    ]
    for side in ("right", "left"):
        some = spark.createDataFrame([r[1:] for r in rows if r[0] == side], "n int, ids array<int>")
        got = some.select(as_padded_text("ids", F.col("n"), side).alias("a"), as_text("ids").alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got]


def test_shuffled_ids_of_any_sign_and_words_exploded_once_for_their_counts(spark):
    low, high = -(2**31), 2**31 - 1
    known = {"a": -1, "b": low, "c": high, "d": 0}
    vocab = checkpoint(spark.createDataFrame(list(known.items()), "tok string, id int"))
    texts = [" ".join(["a b zz c d"] * 40), "d c b a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "prompt string")
    got = encode_words(df, vocab, 150, max_inline_bytes=0, frequent_words=2).collect()
    assert {r.prompt: r.ids for r in got} == {t: [known.get(w, UNK_ID) for w in (t or "").split()[:150]] for t in texts}
    rows = checkpoint(df.select(arrays.words(F.col("prompt")).alias("_words")))
    plan = _frequent(rows, vocab, UNK_ID, 2)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Generate explode") == 1
