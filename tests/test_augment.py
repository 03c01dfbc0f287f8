import logging
from collections import Counter
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomfeed.functions import text as tx
from loomfeed.operators.augment import (
    COLUMN_WORDS,
    SLOT_WORDS,
    augment,
    renumber,
    replicate,
    vary_columns,
    vary_slots,
)
from loomfeed.operators.checks import require_columns
from loomfeed.operators.keys import content_keys, row_keys
from loomfeed.operators.prompts import prompt_full, prompt_optional_input

SCHEMA = "ex_id long, instruction string, input string, output string"
ROWS = [
    (1, "Instruction: a Instruction: b", "Input: i Input: j", "Output: o"),
    (2, "no keyword", None, "ends with Output:"),
    (3, "Instruction: 요약 é", "", "x"),
    (4, "Instruction:", "  ", "Output: Output: Output:"),
    (5, None, "instruction: lower", None),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def by_key(df, *columns):
    return {(r["ex_id"], r["copy_id"]): tuple(r[c] for c in columns) for r in df.collect()}


TEXTS = ("instruction", "input", "output")


def test_replicate(table):
    for n, want in ((3, 3), (1, 1), (0, 1), (-1, 1)):
        got = by_key(replicate(table, n), *TEXTS)
        assert got == {(r[0], c): r[1:] for r in ROWS for c in range(want)}


def test_renumber_is_copy_major_and_dense(spark):
    ids = [7, -3, 100, 10**12, 0]
    df = replicate(spark.createDataFrame([(i,) for i in ids], "ex_id long"), 3)
    got = {(r.ex_id, r.copy_id): r.row_index for r in renumber(df).collect()}
    assert got == {(e, c): c * 5 + p for p, e in enumerate(sorted(ids)) for c in range(3)}


def test_vary_slots_values_come_from_the_tail_of_the_list(table):
    df = replicate(table, 200)
    got = by_key(vary_slots(df), *TEXTS)
    for (ex_id, _), cells in got.items():
        row = dict((r[0], r[1:]) for r in ROWS)[ex_id]
        for i, (before, after) in enumerate(zip(row, cells, strict=True)):
            if before is None:
                assert after is None
            else:
                assert after in {before.replace(SLOT_WORDS[2 * i], w) for w in SLOT_WORDS[2 * i + 1 :]}
    instruction = {cells[0] for key, cells in got.items() if key[0] == 1}
    assert instruction == {f"{w} a {w} b" for w in SLOT_WORDS[1:]}
    assert {cells[1] for key, cells in got.items() if key[0] == 1} == {f"{w} i {w} j" for w in SLOT_WORDS[3:]}
    assert {cells[2] for key, cells in got.items() if key[0] == 1} == {"Response: o"}


def test_vary_slots_needs_six_words(table):
    with pytest.raises(ValueError):
        vary_slots(replicate(table, 1), SLOT_WORDS[:5])


def test_vary_columns_replaces_the_first_only(table):
    got = by_key(vary_columns(replicate(table, 100)), *TEXTS)
    assert {c[0] for k, c in got.items() if k[0] == 1} == {
        f"{w} a Instruction: b" for w in COLUMN_WORDS["instruction"][1:]
    }
    assert {c[2] for k, c in got.items() if k[0] == 4} == {
        f"{w} Output: Output:" for w in COLUMN_WORDS["output"][1:]
    }
    assert {c[2] for k, c in got.items() if k[0] == 2} == {"ends with Response:", "ends with Result:"}
    assert {c[0] for k, c in got.items() if k[0] == 3} == {"Task: 요약 é", "Objective: 요약 é"}
    assert {c[1] for k, c in got.items() if k[0] == 5} == {"instruction: lower"}
    assert {c[:2] for k, c in got.items() if k[0] == 2} == {("no keyword", None)}


def test_missing_cell_kept_or_literal(table):
    one = replicate(table, 1)
    kept = prompt_optional_input(vary_columns(one))
    literal = prompt_optional_input(vary_columns(one, null_literal="nan"))
    prompt = {r.ex_id: r.prompt for r in kept.collect()}
    assert "\nInput:" not in prompt[2] and prompt[5].startswith("Instruction: None\n")
    prompt = {r.ex_id: r.prompt for r in literal.collect()}
    assert "\nInput: nan\n" in prompt[2] and prompt[5].startswith("Instruction: nan\n")
    # not listed: stays missing even with a literal
    unlisted = vary_columns(one, {"output": COLUMN_WORDS["output"]}, null_literal="nan")
    assert by_key(unlisted, "input", "output")[(2, 0)][0] is None
    # listed with too few words: cast to text only
    short = vary_columns(one, {"input": ["Input:"]}, null_literal="nan")
    assert by_key(short, "input")[(2, 0)] == ("nan",)
    assert by_key(short, "input")[(1, 0)] == ("Input: i Input: j",)


def test_absent_column_is_skipped_with_a_warning(table, caplog):
    with caplog.at_level(logging.WARNING):
        out = vary_columns(replicate(table, 1), {"absent": ["a", "b"]})
    assert out.columns == [*table.columns, "copy_id"] and "absent" in caplog.text


def test_numeric_column_is_cast(spark):
    df = replicate(spark.createDataFrame([(1, 105)], "ex_id long, input int"), 1)
    assert vary_columns(df, {"input": ["0", "x"]}).first()["input"] == "1x5"


@pytest.mark.parametrize(
    "apply, repeat, variations, copies",
    [
        (False, 3, COLUMN_WORDS, 1),
        (True, 1, {}, 1),
        (True, 0, None, 1),
        (True, 2, {}, 2),
        (True, 1, {"instruction": []}, 1),
        (True, 1, {"instruction": ["Instruction:"]}, 1),
    ],
)
def test_switches_leave_rows_alone(table, apply, repeat, variations, copies):
    got = by_key(augment(table, apply, repeat, variations), *TEXTS)
    assert got == {(r[0], c): r[1:] for r in ROWS for c in range(copies)}


def test_augment_is_off_by_default(table):
    assert by_key(augment(table, variations=COLUMN_WORDS), *TEXTS) == {(r[0], 0): r[1:] for r in ROWS}


def test_required_columns(table):
    assert require_columns(table) is table
    with pytest.raises(ValueError, match=r"\['input', 'output'\]"):
        require_columns(table.drop("input", "output"))


def test_prompts(spark):
    rows = list(product(["a", None], ["b", "", " ", None], ["c", None]))
    df = spark.createDataFrame(rows, "instruction string, input string, output string")
    for r in prompt_optional_input(prompt_full(df, "full"), "optional").collect():
        assert r.full == f"Instruction: {r.instruction}\nInput: {r.input}\nOutput: {r.output}"
        line = f"Input: {r.input}\n" if r.input else ""
        assert r.optional == f"Instruction: {r.instruction}\n{line}Output: {r.output}"


ALPHABET = st.text(alphabet="ab😀é요:$\\ ", max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ALPHABET, min_size=1, max_size=20), st.text("ab😀:$\\", max_size=2), ALPHABET)
def test_replacements_equal_python(spark, cells, keyword, word):
    df = spark.createDataFrame([(c,) for c in cells], "c string").select(
        "c",
        tx.replace_all("c", keyword, word).alias("every"),
        tx.replace_first("c", keyword, word).alias("first"),
        tx.contains_keyword("c", keyword).alias("has"),
        tx.candidates("c", keyword, [word, "z"]).alias("listed"),
    )
    for r in df.collect():
        assert r.every == r.c.replace(keyword, word)
        assert r.first == r.c.replace(keyword, word, 1)
        assert r.has == (keyword in r.c)
        assert r.listed == [r.c.replace(keyword, word), r.c.replace(keyword, "z")]


def test_has_input(spark):
    df = spark.createDataFrame([("a",), ("",), (" ",), (None,)], "c string").select(tx.has_input("c").alias("h"))
    assert [r.h for r in df.collect()] == [True, False, True, False]


def test_choice_is_uniform_and_independent(spark):
    n, words = 30_000, ["p", "q", "r"]
    df = replicate(spark.range(n // 3).withColumnRenamed("id", "ex_id"), 3)
    for c in ("a", "b"):
        df = df.withColumn(c, tx.choose(words, 7, [F.col("ex_id"), F.col("copy_id"), F.lit(c)]))
    rows = df.collect()
    assert all(abs(k / n - 1 / 3) < 0.015 for k in Counter(r.a for r in rows).values())
    assert all(abs(k / n - 1 / 9) < 0.01 for k in Counter((r.a, r.b) for r in rows).values())
    first = {r.ex_id: r.a for r in rows if r.copy_id == 0}
    pairs = Counter((first[r.ex_id], r.a) for r in rows if r.copy_id == 1)
    assert len(pairs) == 9 and all(abs(k / (n // 3) - 1 / 9) < 0.015 for k in pairs.values())


def test_choice_does_not_depend_on_partitioning(table):
    want = by_key(vary_slots(replicate(table, 20)), *TEXTS)
    for parts in (1, 8, 200):
        assert by_key(vary_slots(replicate(table.repartition(parts), 20)), *TEXTS) == want
    assert by_key(vary_slots(replicate(table, 20), seed=43), *TEXTS) != want


def test_nothing_to_choose():
    with pytest.raises(ValueError):
        tx.choose([], 1, [])


def test_row_keys_are_unique_and_lose_no_row(spark):
    rows = [("hot", None)] * 1000 + [("a", "b"), ("a", "b"), (None, None), ("", None), ("1:a", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    for chunk in (1, 7, 333, 1000, 65_536):
        got = row_keys(df, chunk=chunk).select("ex_id", "x", "y").collect()
        assert Counter((r.x, r.y) for r in got) == Counter(rows)
        assert len({r.ex_id for r in got}) == len(rows)
        numbers = sorted(int(r.ex_id.split("-")[1]) for r in got if r.x == "hot")
        assert numbers == list(range(1000))


def test_content_keys_tell_contents_apart(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("-", None), (None, "-"), ("1:a", "b")]
    df = content_keys(spark.createDataFrame(rows, "x string, y string"))
    assert df.select("ex_id").distinct().count() == len(rows)
