"""Shards: row access without Spark, reading by Spark, and failed or repeated writes."""

import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfeed.session import fresh_path
from loomfeed.sources import ShardRows, read_shards, write_shards
from loomfeed.sources.shards import ShardWriter, Written, index_of


def table(spark, n=1000):
    return spark.range(0, n, 1, 5).select(
        F.col("id").alias("key"),
        (F.col("id") % 99 - 50).cast("short").alias("small"),
        (F.col("id") / 3).cast("float").alias("part"),
        F.expr("transform(sequence(0, 6), i -> cast(id * i as int))").alias("ids"),
        F.expr("array(id, -id, 1L << 62)").alias("wide"),
        F.expr("cast(array() as array<double>)").alias("none"),
    )


def test_rows_by_number_and_by_spark(spark):
    path, df = fresh_path(spark, "shards"), table(spark)
    write_shards(df, path, shard_bytes=3000)
    rows, expected = ShardRows(path), df.orderBy("key").collect()
    assert len(rows) == 1000 and len(rows.shards) > 20
    rng = np.random.default_rng(4)
    for i in [0, 999, -1, -1000, *rng.integers(0, 1000, 200).tolist()]:
        got, want = rows[i], expected[i].asDict()
        assert {k: v.tolist() for k, v in got.items()} == want
    assert isinstance(rows[5]["ids"], np.memmap) and rows[5]["ids"].dtype == np.dtype("<i4")
    for i in (1000, -1001):
        with pytest.raises(IndexError):
            rows[i]
    back = read_shards(spark, path)
    assert back.drop("row").schema.simpleString() == df.schema.simpleString()
    assert [r["row"] for r in back.orderBy("key").collect()] == list(range(1000))
    assert back.drop("row").exceptAll(df).count() == 0 and back.count() == 1000


def test_shards_hold_few_rows_of_any_size(spark):
    path = fresh_path(spark, "shards")
    write_shards(table(spark, 40).coalesce(1), path, shard_bytes=1)  # never less than a row
    assert [s[1:] for s in index_of(path)["shards"]] == [[i, 1] for i in range(40)]
    assert len(ShardRows(path)) == 40


def test_empty_table(spark):
    path, df = fresh_path(spark, "shards"), table(spark).filter("key < 0")
    write_shards(df, path)
    assert len(ShardRows(path)) == 0 and read_shards(spark, path).count() == 0
    assert read_shards(spark, path).columns == ["row", *df.columns]


def test_refused_tables(spark):
    path, df = fresh_path(spark, "shards"), table(spark)
    with pytest.raises(ValueError, match="no fixed width"):
        write_shards(df.withColumn("text", F.lit("x")), path)
    with pytest.raises(FileNotFoundError):
        ShardRows(path)
    write_shards(df, path)
    with pytest.raises(FileExistsError):
        write_shards(df, path)
    clash = fresh_path(spark, "shards")
    write_shards(df.withColumnRenamed("key", "Row"), clash)
    with pytest.raises(Exception, match="name another"):
        read_shards(spark, clash).columns
    assert read_shards(spark, clash, row="number").columns[:2] == ["number", "Row"]


@pytest.mark.parametrize(
    "name, value",
    [
        ("ids", "if(key = 777, array(1, 2), ids)"),
        ("ids", "if(key = 777, null, ids)"),
        ("ids", "if(key = 777, transform(ids, i -> cast(null as int)), ids)"),
        ("key", "if(key = 777, null, key)"),
        # alike in each task, not between tasks
        ("wide", "if(key >= 400, wide, array(key))"),
    ],
)
def test_a_failed_write_leaves_nothing_visible(spark, name, value):
    path = fresh_path(spark, "shards")
    with pytest.raises(Exception, match="holds no nulls|rows of widths"):
        write_shards(table(spark).withColumn(name, F.expr(value)), path, shard_bytes=3000)
    assert not os.path.exists(f"{path}/index.json") and not glob.glob(f"{path}/_*")
    with pytest.raises(FileNotFoundError):
        ShardRows(path)
    # the path can be written again, whatever files the failure left
    write_shards(table(spark), path)
    assert len(ShardRows(path)) == 1000


def test_repeated_tasks_count_once(spark, tmp_path):
    df, path = table(spark, 100).coalesce(1), str(tmp_path / "shards")
    batches = df.toArrow().to_batches()
    writer = ShardWriter(path, df.schema, 3000)
    lost, kept, other = (writer.write(iter(batches)) for _ in range(3))
    assert {n for n, _ in lost.shards}.isdisjoint(n for n, _ in kept.shards)
    writer.commit([kept, None, Written([], None), other])
    rows = ShardRows(path)
    assert len(rows) == 200
    assert [int(rows[i]["key"]) for i in range(200)] == [*range(100), *range(100)]
    writer.abort([lost, None])
    assert not [n for n, _ in lost.shards if glob.glob(f"{path}/{n}*")]
    assert [int(rows[i]["key"]) for i in (0, 150)] == [0, 50]


def test_damaged_shards_are_refused(spark):
    path = fresh_path(spark, "shards")
    write_shards(table(spark).coalesce(1), path)
    name = index_of(path)["shards"][0][0]
    place = f"{path}/{name}.3.npy"
    with open(place, "rb+") as file:
        file.truncate(os.path.getsize(place) - 4)
    with pytest.raises(Exception, match="cut short"):
        read_shards(spark, path).collect()
    index = json.load(open(f"{path}/index.json"))
    index["shards"][0][2] = 7
    json.dump(index, open(f"{path}/index.json", "w"))
    with pytest.raises(Exception, match="in the index"):
        read_shards(spark, path).collect()
