import pytest
from pyspark.sql import functions as F

from loomfeed.operators import assign_batches, from_step, keyed_epochs, place_of, row_at
from loomfeed.operators.permutation import bases
from tests.conftest import node_names


def test_bases_cover_every_total():
    for total in [*range(1, 2000), 10**6, 10**6 + 1, 10**12 + 39]:
        left, right = bases(total)
        assert total <= left * right < total + left


@pytest.mark.parametrize("total", [1, 2, 3, 5, 7, 16, 17, 63, 64, 65, 101, 1000, 4097])
def test_places_are_a_permutation_of_the_rows(spark, total):
    df = keyed_epochs(spark.range(total).withColumnRenamed("id", "row_index"), 2, seed=total)
    back = row_at("position", total, total, F.col("epoch"))
    rows = df.select("row_index", "epoch", "position", back.alias("back")).collect()
    for epoch in range(2):
        assert sorted(r["position"] for r in rows if r["epoch"] == epoch) == list(range(total))
    assert all(r["back"] == r["row_index"] for r in rows)


def test_epochs_and_seeds_differ_and_spread(spark):
    rows = spark.range(5000).select("id", *[place_of("id", 5000, s, e).alias(f"p{s}{e}") for s in (1, 2) for e in (0, 1)])
    table = [tuple(r) for r in rows.orderBy("id").collect()]
    orders = list(zip(*table))[1:]
    assert len(set(orders)) == 4
    for order in orders:
        # neighbours are apart as in a shuffled order: a third of the length on average
        gap = sum(abs(a - b) for a, b in zip(order, order[1:])) / len(order)
        assert 1500 < gap < 1830


def test_big_totals_and_wrong_rows(spark):
    total = 10**12 + 39
    places = spark.range(0, total, total // 997).select("id", place_of("id", total).alias("p"))
    rows = places.select("id", "p", row_at("p", total).alias("back")).collect()
    assert all(r["back"] == r["id"] and 0 <= r["p"] < total for r in rows) and len({r["p"] for r in rows}) == len(rows)
    nothing = spark.range(1).select(place_of(F.lit(None).cast("long"), 5).alias("p"))
    assert nothing.first()["p"] is None
    for wrong in (5, -1):
        with pytest.raises(Exception, match="not below"):
            spark.range(1).select(place_of(F.lit(wrong), 5)).collect()
    assert keyed_epochs(spark.range(0).withColumnRenamed("id", "row_index")).count() == 0


def test_an_epoch_is_a_projection_and_resumes_anywhere(spark):
    rows = spark.range(103).withColumnRenamed("id", "row_index")
    placed = keyed_epochs(rows, 4, 103)
    assert not node_names(placed) & {"Join", "Aggregate", "Sort", "Window", "Repartition", "RepartitionByExpression"}
    whole = assign_batches(placed, 2, 3, 2)
    rest = assign_batches(from_step(placed, 5, 2, 3, 2), 2, 3, 2)
    assert sorted(map(tuple, whole.filter("step >= 5").collect())) == sorted(map(tuple, rest.collect()))
    # the rows of one step, without a look at the others
    step = spark.range(60, 72).select(row_at("id", 103, epoch=2).alias("row_index"))
    expected = whole.filter("epoch = 2 and step = 5").select("row_index")
    assert sorted(step.collect()) == sorted(expected.collect())
