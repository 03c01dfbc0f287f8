import random
from collections import Counter

import numpy as np
import pytest

from loomfeed.llm import decontaminate, toxicity
from loomfeed.llm.fm_index import FMIndex
from tests.conftest import plan_nodes
from tests.llm import brute

DOCS = "doc_id long, text string, items string, n_words string"
ITEMS = "item_id long, text string, doc_id string"


def test_index_counts_and_locates():
    rng = np.random.default_rng(0)
    for size in (1, 5, 300):
        text = rng.integers(0, 4, size)
        index = FMIndex(text, 3)
        patterns = rng.integers(1, 4, (40, 3))
        lengths = rng.integers(1, 4, 40)
        low, high = index.search(patterns, lengths)
        for p, n, a, b in zip(patterns, lengths, low, high):
            places = [i for i in range(size - n + 1) if (text[i : i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == places


@pytest.mark.parametrize("block", [1, 1 << 24])
def test_leaks_equal_brute_force(spark, block):
    rng = random.Random(2)
    word = lambda: f"b{rng.randrange(30)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 9, 10, 11, 25, 25, 1])]
    items += [(7, None), (8, "?!"), (9, items[4][1]), (10, items[4][1].upper()), (None, items[2][1])]
    texts = [" ".join(word() for _ in range(rng.randrange(1, 200))) for _ in range(12)]
    texts += [f"Intro: {items[4][1].title()}, end", items[4][1], items[3][1] + " " + items[3][1], None, "", "-- é"]
    texts += ["x " * 3000 + items[2][1]]
    rows = [(i if i else None, t, "c", str(i)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    found = decontaminate.find_leaks(docs, bench, block_bytes=block)
    got = {r["doc_id"] or 0: r for r in found.collect()}
    for i, (words, covered, owners) in enumerate(brute.leaks(texts, items)):
        marks = {p for s in got[i]["spans"] for p in range(s["start"], s["stop"])}
        assert got[i]["n_words"] == len(words)
        assert marks == {p for p, c in enumerate(covered) if c}
        assert got[i]["items"] == sorted(str(o) for o in owners if o is not None)
    cleaned = {r["doc_id"] or 0: r["text"] for r in decontaminate.remove_leaks(docs, found).collect()}
    for i, (words, covered, _) in enumerate(brute.leaks(texts, items)):
        kept = [w for w, c in zip(words, covered) if not c]
        assert brute.FOLDED.findall(brute.lower(cleaned[i])) == kept
        if not any(covered):
            assert cleaned[i] == texts[i]


@pytest.mark.parametrize("block", [1, 1 << 24])
def test_leaks_are_cut_where_they_are_found(spark, block):
    words = "one two three four five six seven eight nine ten"
    rows = [(1, f"A. {words}, end", "c", "d"), (1, f"A. {words}, end", "c", "d"), (2, None, "c", "d"), (None, "é no", "c", "d")]
    rows += [(3, words, "c", "d"), (4, "", "c", "d"), (5, f"{words} one two three", "c", "d"), (6, "x y z", None, "d")]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([(1, words, "z"), (2, "x y z", "z"), (3, None, "z")], ITEMS)
    found = decontaminate.find_leaks(docs, bench, block_bytes=block)
    cut = decontaminate.cut_leaks(docs, bench, block_bytes=block)
    assert cut.dtypes == found.dtypes
    assert sorted(map(repr, cut.drop("text").collect())) == sorted(map(repr, found.drop("text").collect()))
    freed = decontaminate.remove_leaks(docs, found).select("doc_id", "text")
    assert sorted(map(repr, cut.select("doc_id", "text").collect())) == sorted(map(repr, freed.collect()))
    # a task of the pipeline's stage keeps one Python process
    assert [name for name, _ in plan_nodes(cut)].count("MapInArrow") == 1


def test_leaks_of_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b", "", "")], DOCS), spark.createDataFrame([], ITEMS)
    docs = docs.select("doc_id", "text")
    assert decontaminate.find_leaks(docs, bench).first()["spans"] == []
    assert decontaminate.find_leaks(docs.filter("false"), bench).count() == 0


@pytest.mark.parametrize("block_bytes", [1 << 20, 1])
def test_repeated_benchmark_rows_count_once(spark, block_bytes):
    words, other = "one two three four five six seven eight nine ten", "x y z"
    items = [("b", words), ("b", words), ("a", words), ("b", other), ("c", other)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = spark.createDataFrame([(1, f"{words} and {other}"), (2, "q " + other), (3, None)], "doc_id long, text string")
    found = decontaminate.find_leaks(docs, bench, block_bytes=block_bytes)
    got = {r["doc_id"]: r["items"] for r in found.collect()}
    assert got == {1: ["a", "b", "c"], 2: ["b", "c"], 3: []}


def test_folding():
    assert toxicity.fold("Id1ot!! іdiоt ＩＤＩＯＴ") == " idiot idiot idiot "
    assert toxicity.fold("") == toxicity.fold("...") == "  "


def test_exceptions_take_back_the_weight():
    model = toxicity.Model({" trash ": 5.0}, {" trash can ": 5.0}, (-4.0, 8.0, 0.0, 0.0))
    assert model.found("what trash") == (5.0, 1, 2)
    assert model.found("a trash can") == (0.0, 0, 3)
    assert model.score("what tr4sh") > 0.7 > model.score("a trash can")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumnRenamed("source", "score_of")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    scored = toxicity.add_scores(docs, model)
    assert set(docs.columns) < set(scored.columns)
    rows = scored.join(labels, "doc_id").filter(toxicity.bucket("doc_id", 3) == 1)
    counts = Counter((r["toxic"], r["score"] >= 0.7) for r in rows.collect())
    caught = counts[1, True] / (counts[1, True] + counts[1, False])
    wrong = counts[0, True] / (counts[0, True] + counts[0, False])
    assert caught > 0.85 and wrong < 0.01


def test_scores_of_unusual_rows(spark):
    model = toxicity.Model({" scum ": 5.0}, {}, (-4.0, 8.0, 0.0, 0.0))
    rows = [(1, None), (2, ""), (None, "scum"), (None, "scum"), (3, "fine " * 50_000)]
    found = toxicity.add_scores(spark.createDataFrame(rows, "doc_id long, text string"), model)
    assert sorted(r["score"] > 0.5 for r in found.collect()) == [False, False, False, True, True]
    none = toxicity.fit(spark.createDataFrame([(1, "a", 0)], "doc_id long, text string, toxic int"))
    assert none.weights == {} and none.score("anything") < 0.5
    assert toxicity.add_scores(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0
