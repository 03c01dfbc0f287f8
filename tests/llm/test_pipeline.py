import corpus_pipeline
from loomfeed.llm import packing, toxicity
from loomfeed.llm.common import store
from loomfeed.llm.queries import QUERIES
from tests.conftest import node_names, plan_nodes
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, kinds = docs.columns, docs.dtypes
    model = toxicity.fit(toxicity.training_rows(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")))
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, FOLDER), name)
        results.append({r["doc_id"]: r for r in docs.collect()} if name != "packing" else docs.collect())
        if name != "packing":
            assert (docs.columns, docs.dtypes) == (names, kinds)
    given = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}

    clean, single, cut, free, packed = results
    assert clean.keys() == {k for k, r in given.items() if model.score(r["text"] or "") < toxicity.THRESHOLD}
    ids = sorted(clean)
    roots = brute.components([brute.fingerprint(clean[i]["text"]) for i in ids], brute.near)
    assert sorted(single) == [ids[i] for i in sorted(set(roots))]
    ids = sorted(single)
    for i, (words, covered) in zip(ids, brute.repeats([single[i]["text"] for i in ids], 35)):
        assert cut[i]["text"].split() == [w for w, c in zip(words, covered) if not c]
        assert cut[i]["n_chars"] == (len(cut[i]["text"]) if any(covered) else single[i]["n_chars"])
    for i, (words, covered, _) in zip(ids, brute.leaks([cut[i]["text"] for i in ids], items)):
        kept = [w for w, c in zip(words, covered) if not c]
        assert brute.FOLDED.findall(brute.lower(free[i]["text"])) == kept
    assert {r["doc_id"] for r in packed} == set(free)


def test_stages_keep_unusual_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "a b c d", "en", None, 7)]
    docs = spark.createDataFrame(rows, schema)
    docs = store(docs, "unusual")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, FOLDER), "stage")
    # texts without words are one group of near copies
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 3]
    empty = store(spark.createDataFrame([], schema), "empty")
    for _, stage in corpus_pipeline.STAGES:
        empty = store(stage(spark, empty, FOLDER), "stage")
    assert empty.count() == 0


def test_stages_keep_one_python_process_a_task(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    nodes = [name for name, _ in plan_nodes(corpus_pipeline.cut_leaks(spark, docs, FOLDER))]
    assert nodes.count("MapInArrow") == 1
    # rows that the driver makes don't pass through Python workers
    rows = spark.createDataFrame([(1, 0, 5), (2, 0, 1024), (3, 0, 9)], "row long, start long, length long")
    assert "LogicalRDD" not in node_names(packing.place(store(rows, "cut")))


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
