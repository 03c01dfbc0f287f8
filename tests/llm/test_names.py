"""Columns that carry the names operators add or use inside."""

import corpus_pipeline
import pytest

from loomfeed.llm import decontaminate, substrings, toxicity
from loomfeed.llm.common import store

FOLDER = "/root/testdata/sf0.001"
# every column that a stage adds, joins by or uses inside
NAMES = ["score", "n_words", "n_removed", "spans", "_spans", "items", "row", "_row", "rest", "hit", "of", "marks", "own"]
NAMES += ["key", "fp", "component_id", "label", "_key", "_label", "anchor", "content", "_text_key", "of.dotted"]

PASSAGE = " ".join(f"p{i}" for i in range(60))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "only here " + PASSAGE), (2, "and there " + PASSAGE), (3, None), (3, None), (None, "short"), (5, "")]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
    return store(spark.createDataFrame([(*r, *NAMES) for r in rows], schema), "names")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_return_clashing_columns(spark, docs, name):
    done = dict(corpus_pipeline.STAGES)[name](spark, docs, FOLDER)
    assert (done.columns, done.dtypes) == (docs.columns, docs.dtypes)
    rows = done.collect()
    assert rows and all(list(r[2:]) == NAMES for r in rows)


def test_packing_stage_with_clashing_columns(spark, docs):
    assert corpus_pipeline.pack(spark, docs, FOLDER).count() == 6


def test_operators_replace_columns_of_the_names_they_add(spark, docs):
    cut = substrings.remove_repeats(docs)
    assert sorted(cut.columns) == sorted(docs.columns)
    assert {(r["n_words"], r["n_removed"]) for r in cut.collect()} == {(62, 60), (0, 0), (1, 0)}
    bench = spark.createDataFrame([(None, "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10"), (4, "only here")], "item_id long, text string")
    for block in (1, 1 << 20):
        found = decontaminate.find_leaks(docs, bench, block_bytes=block)
        assert sorted(found.columns) == sorted(docs.columns)
        assert [r["items"] for r in found.orderBy("doc_id").collect()][1:3] == [["4"], []]
    scored = toxicity.add_scores(docs, toxicity.Model())
    assert sorted(scored.columns) == sorted(docs.columns) and dict(scored.dtypes)["score"] == "double"


def test_many_blocks_of_a_benchmark(spark, docs):
    items = [(i, " ".join(f"p{j}" for j in range(i, i + 12))) for i in range(20)] * 2
    bench = spark.createDataFrame(items, "item_id long, text string")
    small, whole = (
        {(r["doc_id"], r["text"]): (r["n_words"], r["spans"], r["items"]) for r in found.collect()}
        for found in (decontaminate.find_leaks(docs, bench, block_bytes=b) for b in (1, 1 << 20))
    )
    assert small == whole
    assert whole[1, "only here " + PASSAGE][2] == sorted(str(i) for i in range(20))
