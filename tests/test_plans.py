import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loomfeed import session
from loomfeed.operators.vocab import build_vocab, word_level_json
from loomfeed.plans.examples import examples_from_conversations
from loomfeed.plans.prepare import encode, prepare_v1, prepare_v2, render_v1, render_v2
from loomfeed.session import checkpoint
from tests.conftest import node_names

PLAIN_SQL = """
with p as (
  select conv_id, turn, role, text,
         lead(text) over (partition by conv_id order by turn) nt,
         lead(role) over (partition by conv_id order by turn) nr
  from conversations),
s as (
  select conv_id, min(text) sys from conversations
  where role = 'system' group by conv_id)
select concat_ws('-', p.conv_id, p.turn) as ex_id,
       case when p.conv_id % 5 = 0 then p.text
            else concat('Instruction: ', p.text) end as instruction,
       case when s.sys is not null
              then concat('Input: ', s.sys, ' Input: ', s.sys)
            when p.conv_id % 7 = 0 then '' end as input,
       concat('Output: ', p.nt) as output
from p left join s on p.conv_id = s.conv_id
where p.role = 'user' and p.nr = 'assistant'
"""

ROWS = [
    ("Instruction: a", "Input: i", "Output: o", "x"),
    ("Instruction: a", "Input: i", "Output: o", "x"),
    ("b", None, "Output: p", "y"),
]
SCHEMA = "instruction string, input string, output string, extra string"


def plain(spark, folder):
    spark.read.parquet(f"{folder}/conversations.parquet").createOrReplaceTempView("conversations")
    return spark.sql(PLAIN_SQL)


@pytest.mark.parametrize("chunk", [1, 2, 3, 1024])
def test_examples_for_any_chunk_size(spark, chunk):
    folder = "/root/testdata/sf0.001"
    got, want = examples_from_conversations(spark, folder, chunk), plain(spark, folder)
    assert want.count() == 34 and got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("chunk", [16, 1024])
def test_examples_with_one_long_conversation(spark, tmp_path, chunk):
    """One conversation with most rows, gaps between turns, a system turn in the middle."""
    turn = F.col("id")
    role = (
        F.when(turn == 700, "system").when(turn % 5 == 4, "tool").when(turn % 2 == 0, "user").otherwise("assistant")
    )
    long = spark.range(3000).filter(~F.col("id").between(1000, 1500)).select(
        F.lit(3).cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"),
        F.concat(F.lit("t"), turn.cast("string")).alias("text"),
    )
    other = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").filter("conv_id <> 3")
    long.unionByName(other).write.parquet(str(tmp_path / "conversations.parquet"))
    got = examples_from_conversations(spark, str(tmp_path), chunk)
    want = plain(spark, str(tmp_path))
    assert want.count() > 500 and got.select("ex_id").distinct().count() == got.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_examples_without_a_conversation(spark, tmp_path):
    rows = [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (1, 0, "user", "q"), (1, 1, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    got, want = examples_from_conversations(spark, str(tmp_path)), plain(spark, str(tmp_path))
    assert got.count() == 2 and got.exceptAll(want).count() == 0


def test_prepare_reports_counts(spark):
    df, seen = spark.createDataFrame(ROWS, SCHEMA), Observation()
    vocab = checkpoint(build_vocab(render_v2(df), size=20))
    prepare_v2(df, vocab, max_length=8, observation=seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows_before": 3, "rows_after": 9}


def test_rendering_drops_source_columns_and_keeps_equal_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for out in (render_v1(df), render_v2(df)):
        assert out.columns == ["ex_id", "copy_id", "prompt"]
        assert out.count() == 9 and out.select("ex_id").distinct().count() == 3
    assert render_v2(df).select("ex_id", "copy_id").distinct().count() == 9


def test_rendering_needs_its_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).drop("input")
    for render in (render_v1, render_v2):
        with pytest.raises(ValueError, match="'input'"):
            render(df)


def test_generations_differ_where_input_is_missing(spark):
    df = spark.createDataFrame([(1, "b", None, "c")], "ex_id long, instruction string, input string, output string")
    assert render_v1(df).first().prompt == "Instruction: b\nInput: None\nOutput: c"
    assert render_v2(df).first().prompt == "Instruction: b\nOutput: c"
    assert render_v2(df, null_literal="nan").first().prompt == "Instruction: b\nInput: nan\nOutput: c"
    assert render_v2(df, apply=False, null_literal="nan").first().prompt == "Instruction: b\nOutput: c"


def test_prepare_shapes_and_tokenizers(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    vocab = checkpoint(build_vocab(render_v2(df), size=20))
    for how in ({"vocab": vocab}, {"tokenizer_json": word_level_json(vocab)}):
        v1, v2 = prepare_v1(df, **how), prepare_v2(df, max_length=7, **how)
        assert v1.columns == ["ex_id", "copy_id", "input_ids", "attention_mask"]
        assert v2.columns == [*v1.columns, "labels"]
        assert {len(r.input_ids) for r in v1.collect()} == {512}
        rows = v2.collect()
        assert len(rows) == 9 and {len(r.labels) for r in rows} == {7}
        assert all(sum(r.attention_mask) == sum(i != -100 for i in r.labels) for r in rows)
    assert sorted(prepare_v2(df, vocab=vocab).collect()) == sorted(
        prepare_v2(df, tokenizer_json=word_level_json(vocab)).collect()
    )


def test_encode_takes_one_tokenizer(spark):
    with pytest.raises(ValueError):
        encode(spark.range(1), 4)


def test_prepare_is_one_stage_after_the_keys(spark, tmp_path):
    """From stored examples to model input nothing is shuffled."""
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("ex_id", F.monotonically_increasing_id())
    df.write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    vocab = checkpoint(build_vocab(render_v2(stored), size=20))
    out = prepare_v2(stored, vocab=vocab, max_length=8)
    assert node_names(out) <= {"Project", "Generate", "LogicalRelation", "Relation", "Filter"}
    scan = next(line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "extra" not in scan


def test_shared_folder_is_the_one_the_session_names(spark, tmp_path, monkeypatch):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_path(spark, "a") != session.fresh_path(spark, "a")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
