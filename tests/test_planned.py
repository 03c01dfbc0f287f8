"""Files of planned size: even sizes on a skewed folder, and readers that trust the manifest."""

import collections
import os

import pytest
from pyspark.sql import functions as F

from loomfeed.session import fresh_path
from loomfeed.sources import read_planned, write_planned
from loomfeed.sources.planned import manifest_of, planned, row_bytes


def skewed(spark, n=60_000):
    """Nine of ten rows in one folder, a third of all rows equal."""
    return spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 10 == 0, "test").otherwise("train").alias("split"),
        F.when(F.col("id") % 3 == 0, F.sha2(F.lit("x"), 512))
        .otherwise(F.sha2(F.col("id").cast("string"), 512)).alias("text"),
    )


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_sizes_on_a_skewed_folder(spark):
    df, target = skewed(spark), 200_000
    dealt = planned(df, ["split"], target)
    assert dealt.select("row.*").columns == df.columns
    sized = dealt.select("folder", "file", *[F.col(f"row.{c}") for c in df.columns])
    sized = sized.groupBy("folder", "file").agg(F.sum(row_bytes(df.schema)).alias("bytes")).collect()
    files = collections.Counter(r["folder"] for r in sized)
    assert sorted(files.values())[1] > 8 * sorted(files.values())[0] > 8
    assert all(0.85 * target < r["bytes"] < 1.15 * target for r in sized)
    mean = sum(r["bytes"] for r in sized) / len(sized)
    assert abs(mean - target) < 0.1 * target


def test_one_file_each_and_rows_come_back(spark):
    path, df = fresh_path(spark, "planned"), skewed(spark, 6000)
    write_planned(df, path, file_bytes=100_000)
    names = [name for name, _ in manifest_of(path)["files"]]
    folders = [os.path.dirname(n) for n in names]
    assert len(names) == len(set(folders)) > 5
    back = read_planned(spark, path)
    assert back.dtypes == df.dtypes and sorted_rows(back) == sorted_rows(df)
    with pytest.raises(FileExistsError):
        write_planned(df, path)


def test_stray_files_are_not_seen(spark):
    path, df = fresh_path(spark, "planned"), skewed(spark, 300)
    df.write.parquet(f"{path}/data-of-a-failed-write")
    with pytest.raises(FileNotFoundError):
        read_planned(spark, path)
    write_planned(df, path)
    folder = os.path.dirname(f"{path}/{manifest_of(path)['files'][0][0]}")
    df.select(F.struct("*").alias("row")).coalesce(1).write.mode("append").parquet(folder)
    assert read_planned(spark, path).count() == 300


def test_failed_write_leaves_nothing_visible(spark):
    path = fresh_path(spark, "planned")
    bad = skewed(spark, 100).withColumn("text", F.expr("if(id = 50, raise_error('no'), text)"))
    with pytest.raises(Exception, match="no"):
        write_planned(bad, path)
    with pytest.raises(FileNotFoundError):
        read_planned(spark, path)


def test_nulls_clashing_names_nested_values_and_no_folder(spark):
    kind = "row long, folder string, file int, `_0` array<int>, `a.b` struct<x:string,y:double>, m map<string,int>"
    rows = [(1, None, 3, [1, None], ("é", 0.5), {"k": 1}), (2, "", None, None, None, None), (2, "", None, None, None, None)]
    df = spark.createDataFrame(rows, kind)
    for by, folders in (([], 1), (["folder"], 2), (["folder", "file"], 2), (["a.b"], 2)):
        path = fresh_path(spark, "planned")
        write_planned(df, path, by)
        assert len({n.split("/")[1] for n, _ in manifest_of(path)["files"]}) == folders
        back = read_planned(spark, path)
        assert back.dtypes == df.dtypes and sorted_rows(back) == sorted_rows(df)
        empty = fresh_path(spark, "planned")
        write_planned(df.filter("row > 5"), empty, by)
        assert manifest_of(empty)["files"] == [] and read_planned(spark, empty).count() == 0
    with pytest.raises(ValueError):
        write_planned(df, fresh_path(spark, "planned"), [], file_bytes=0)
