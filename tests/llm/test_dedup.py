import random

import pytest

from loomfeed.llm import simhash, substrings
from loomfeed.llm.automaton import SuffixAutomaton
from loomfeed.llm.components import components
from loomfeed.session import fresh_path
from tests.llm import brute

DOCS = "doc_id long, text string, anchor string, `key` int"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_fingerprints_equal_brute_force():
    rng = random.Random(1)
    texts = ["", " \t\n", "One", "one TWO", "A b\x0bC d", "é É ü " * 5, prose(rng, 3000), "x " * 500]
    for text in texts:
        assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


@pytest.mark.parametrize("longest", [0, 2, 128])
def test_links_give_the_components_of_all_pairs(spark, longest):
    rng = random.Random(longest)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = {b ^ sum(1 << i for i in set(rng.sample(range(64), rng.randrange(5)))) for b in base for _ in range(40)}
    values |= {0, 1, (1 << 64) - 1}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = components(simhash.links(frame, longest))
    roots = {r["node"]: r["root"] for r in found.collect()}
    expected = brute.components(values, brute.near)
    groups = {}
    for s, e in zip(signed, expected):
        groups.setdefault(e, set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({min(g) for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_rounds_of_components_write_no_more_files_than_their_edges_need(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "u long, v long")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = components(edges)
        assert len(found.inputFiles()) == 1
        monkeypatch.setattr("loomfeed.llm.components.FILE_EDGES", 20)
        more = components(edges)
        assert len(more.inputFiles()) == 4
        assert sorted(found.collect()) == sorted(more.collect()) == [(i, 0) for i in range(61)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_near_duplicates_of_unusual_rows(spark):
    rng = random.Random(3)
    text = prose(rng, 200)
    rows = [(5, text, "a", 1), (3, text, None, None), (3, text, "a", 1), (None, text, "a", 1)]
    rows += [(9, None, None, None), (8, "", None, 1), (7, prose(rng, 50), "a", 1)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in found)
    assert got == [(-1, 3), (3, 3), (3, 3), (5, 3), (7, 7), (8, 8), (9, 8)]
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 8]
    assert kept.columns == ["doc_id", "text", "anchor", "key"]
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_keep_one_survives_another_packing_of_files(spark):
    rng = random.Random(6)
    folder = fresh_path(spark, "packed")
    rows = [(i, prose(rng, 40), "a", 1) for i in range(40)]
    spark.createDataFrame(rows + rows, DOCS).repartition(20).write.parquet(folder)
    name = "spark.sql.files.openCostInBytes"
    kept = simhash.keep_one(spark.read.parquet(folder))
    before = spark.conf.get(name)
    spark.conf.set(name, 1 << 28)  # the last scan deals files otherwise
    try:
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    finally:
        spark.conf.set(name, before)


def test_automaton_finds_repeats():
    rng = random.Random(4)
    for _ in range(30):
        lists = [[rng.randrange(3) for _ in range(rng.randrange(1, 30))] for _ in range(4)]
        weights = [rng.choice([1, 1, 2]) for _ in lists]
        automaton = SuffixAutomaton(list(zip(lists, weights)))
        least = rng.randrange(2, 6)
        counts = {}
        for words, weight in zip(lists, weights):
            for i in range(len(words) - least + 1):
                key = tuple(words[i : i + least])
                counts[key] = counts.get(key, 0) + weight
        for words in lists:
            covered = set()
            for i in range(len(words) - least + 1):
                if counts[tuple(words[i : i + least])] > 1:
                    covered |= set(range(i, i + least))
            got = {p for a, b in automaton.repeated(words, least) for p in range(a, b)}
            assert got == covered


def repeated_texts():
    rng = random.Random(5)
    passage, other = prose(rng, 60), prose(rng, 40)
    texts = [prose(rng, 80) for _ in range(6)]
    texts += [f"{prose(rng, 30)} {passage}\n\t{prose(rng, 20)}" for _ in range(5)]
    edited = passage.split()
    for i in range(12):  # near copies: one word of the passage differs
        words = list(edited)
        words[rng.randrange(60)] = f"e{i}"
        texts.append(f"{prose(rng, 10)} {' '.join(words)} {prose(rng, 5)}")
    texts += [f"{other} {prose(rng, 9)} {other}", texts[0], texts[0], None, "", "short", "tick " * 200]
    texts += [" ".join(f"w{i}" for i in range(34)), " ".join(f"w{i}" for i in range(34))]
    return texts


@pytest.mark.parametrize("hot", [2048, 1])
def test_repeats_equal_brute_force(spark, hot):
    texts = repeated_texts()
    rows = [(i if i % 7 else None, t, f"n{i}", i) for i, t in enumerate(texts)]
    found = substrings.remove_repeats(spark.createDataFrame(rows, DOCS), hot=hot)
    got = {r["key"]: r for r in found.collect()}
    for i, (words, covered) in enumerate(brute.repeats(texts, 35)):
        kept = [w for w, c in zip(words, covered) if not c]
        assert (got[i]["n_words"], got[i]["n_removed"]) == (len(words), sum(covered))
        assert (got[i]["text"] or "").split() == kept and got[i]["anchor"] == f"n{i}"
        if not any(covered):
            assert got[i]["text"] == texts[i]
    assert sum(r["n_removed"] for r in got.values()) > 1000


def test_repeats_of_an_empty_table(spark):
    found = substrings.remove_repeats(spark.createDataFrame([], DOCS))
    assert found.count() == 0 and found.columns[-2:] == ["n_words", "n_removed"]
