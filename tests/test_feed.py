import math
import hashlib
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loomfeed.operators import position
from loomfeed.operators.augment import renumber, replicate
from loomfeed.operators.feed import assign_batches, collate, epochs, split, split_by_hash
from loomfeed.operators.position import hashed_position, ordered_position
from loomfeed.operators.report import augment_report, observe_report
from loomfeed.operators.tokens import finish_ids
from tests.conftest import node_names


def table(spark, n, copies=2, parts=None):
    df = replicate(spark.range(n).withColumnRenamed("id", "ex_id"), copies)
    return df.repartition(parts) if parts else df


@pytest.mark.parametrize("n, share", [(1, 0.1), (10, 0.1), (37, 0.1), (300, 0.5), (300, 0.0), (300, 1.0), (0, 0.1)])
def test_split_is_exact_and_keeps_copies_together(spark, n, share):
    got = split(table(spark, n), share, 3).collect()
    assert len(got) == 2 * n
    sides = {}
    for r in got:
        sides.setdefault(r.ex_id, set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    test = {e for e, s in sides.items() if s == {"test"}}
    order = sorted(range(n), key=lambda e: hashlib.md5(f"3|{e}".encode()).hexdigest())
    assert test == set(order[: math.ceil(n * share)])


def test_split_without_copies_and_with_text_keys(spark):
    df = spark.range(50).select(F.concat(F.lit("k-"), "id").alias("ex_id"))
    assert Counter(r.split for r in split(df, 0.2).collect()) == {"test": 10, "train": 40}


def test_split_does_not_shuffle_the_table(spark):
    assert not node_names(split(table(spark, 50))) & {"Join", "Window", "Aggregate", "Sort"}


def test_split_by_hash_is_near_the_share(spark):
    got = Counter(r.split for r in split_by_hash(table(spark, 20_000, 1), 0.1).collect())
    assert abs(got["test"] / 20_000 - 0.1) < 0.01


def test_each_epoch_is_its_own_permutation(spark):
    n = 500
    got = epochs(table(spark, n), 3, 5).collect()
    orders = []
    for e in range(3):
        rows = sorted((r.position, r.ex_id, r.copy_id) for r in got if r.epoch == e)
        assert [r[0] for r in rows] == list(range(2 * n))
        assert len({r[1:] for r in rows}) == 2 * n
        orders.append([r[1:] for r in rows])
    assert orders[0] != orders[1] != orders[2] != orders[0]


def test_epochs_do_not_depend_on_partitioning(spark):
    want = {tuple(r) for r in epochs(table(spark, 300), 2).collect()}
    for parts in (1, 8, 200):
        assert {tuple(r) for r in epochs(table(spark, 300, parts=parts), 2).collect()} == want


def test_epochs_carry_other_columns(spark):
    df = table(spark, 40).withColumn("payload", F.col("ex_id") * 10)
    got = epochs(df, 2).collect()
    assert len(got) == 40 * 2 * 2 and all(r.payload == r.ex_id * 10 for r in got)


@pytest.mark.parametrize("rows", [65_536, 100, 3])
def test_hashed_position_for_any_bucket_size(spark, monkeypatch, rows):
    monkeypatch.setattr(position, "BUCKET_ROWS", rows)
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("int").alias("g"))
    out = hashed_position(df, F.md5(F.col("id").cast("string")), ["id"], "g").collect()
    for g in range(7):
        ids = sorted((i for i in range(1000) if i % 7 == g), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        assert {r.id: r.position for r in out if r.g == g} == {i: p for p, i in enumerate(ids)}


def test_ordered_position_of_clustered_keys(spark):
    ids = [*range(1000), 10**15, -(10**15), 10**15 + 1]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    out = {r.id: r.position for r in ordered_position(df, ["id"]).collect()}
    assert out == {i: p for p, i in enumerate(sorted(ids))}


@pytest.mark.parametrize("batch, world, accum", [(2, 1, 2), (2, 3, 2), (4, 2, 1)])
def test_assign_batches(spark, batch, world, accum):
    n = 101
    rows = assign_batches(spark.range(n).withColumnRenamed("id", "position"), batch, world, accum).collect()
    assert len({(r.rank, r.micro, r.slot) for r in rows}) == n
    assert all(r.slot < batch and r.rank < world and r.step == r.micro // accum for r in rows)
    per_step = Counter(r.step for r in rows)
    assert all(per_step[s] == batch * world * accum for s in range(n // (batch * world * accum)))
    per_batch = Counter((r.micro, r.rank) for r in rows)
    assert sorted(per_batch.values())[1:] == [batch] * (len(per_batch) - 1)


def test_collate(spark):
    ids = table(spark, 21, 1).withColumn("ids", F.array_repeat(F.col("ex_id").cast("int"), (F.col("ex_id") % 5).cast("int")))
    ready = finish_ids(ids, 4, 0)
    fed = assign_batches(epochs(ready, 2), 2, 2, 1)
    rows = {(r.epoch, r.micro, r.rank, r.slot): r for r in fed.collect()}
    batches = collate(fed, 0).collect()
    assert sum(len(b.ex_id) for b in batches) == len(rows)
    for b in batches:
        for slot in range(len(b.ex_id)):
            r = rows[(b.epoch, b.micro, b.rank, slot)]
            assert (b.ex_id[slot], b.input_ids[slot], b.attention_mask[slot]) == (r.ex_id, r.input_ids, r.attention_mask)
            assert b.labels[slot] == [-100 if i == 0 else i for i in r.input_ids]


EQUAL = [("a", 0), ("a", 0), ("a", 0), (None, 0), (None, 0), ("b", None)]


def test_epochs_keep_rows_with_equal_and_null_keys(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(EQUAL)], "ex_id string, copy_id int, payload int")
    for rows in (df, df.drop("payload")):
        got = epochs(rows, 2).collect()
        assert Counter((r.ex_id, r.copy_id, r.epoch) for r in got) == Counter((*k, e) for k in EQUAL for e in (0, 1))
        for e in (0, 1):
            assert sorted(r.position for r in got if r.epoch == e) == list(range(len(EQUAL)))
    batches = collate(assign_batches(epochs(df.withColumns({"input_ids": F.array(F.lit(1)), "attention_mask": F.array(F.lit(1))}), 2), 2))
    assert max(len(r.ex_id) for r in batches.collect()) == 2


def test_no_join_on_the_users_key(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(EQUAL)], "ex_id string, copy_id int, payload int")
    for out in (epochs(df, 2), renumber(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line]
        assert joins and not any("ex_id" in line or "copy_id" in line for line in joins)


def test_renumber_equal_and_null_keys(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(EQUAL)], "ex_id string, copy_id int, payload int")
    got = sorted(renumber(df).collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in got] == list(range(len(EQUAL)))
    assert [(r.copy_id, r.ex_id) for r in got] == [(None, "b"), (0, None), (0, None), (0, "a"), (0, "a"), (0, "a")]
    assert sorted(r.payload for r in got) == list(range(len(EQUAL)))


def test_split_counts_distinct_examples(spark):
    df = spark.createDataFrame([("hot",)] * 50 + [(f"k{i}",) for i in range(18)] + [(None,)] * 3, "ex_id string")
    got = split(df, 0.1, 1).collect()
    assert len(got) == 71
    sides = {k: {r.split for r in got if r.ex_id == k} for k in {r.ex_id for r in got}}
    assert all(len(s) == 1 for s in sides.values())
    assert sum(s == {"test"} for s in sides.values()) == 2


def test_report(spark):
    df = table(spark, 12, 3)
    assert augment_report(df).first().asDict() == {"rows_before": 12, "rows_after": 36}
    seen = Observation()
    observe_report(df, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows_before": 12, "rows_after": 36}
