import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from loomfeed.llm import importance
from loomfeed.llm.common import store

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [" ".join(p) for p in zip(words, words[1:])]


def brute(docs, target):
    def bucket(g):
        return zlib.crc32(g.encode()) % 10000

    source = Counter(bucket(g) for _, t in docs for g in grams(t)[1])
    goal = Counter(bucket(g) for t in target for g in grams(t)[1])
    s_all, t_all = sum(source.values()), sum(goal.values())
    out = []
    for key, text in docs:
        words, found = grams(text)
        gains = [
            math.floor(1000 * math.log((goal[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000))))
            for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(words), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0]))
    for i, r in enumerate(able[: 25 * len(able) // 100]):
        r[5] = i + 1
    return out


def test_features_do_not_depend_on_the_parts():
    rng = random.Random(1)
    text = " ".join(rng.choice(["Ab", "é", "x1", "--", "lang" * 9]) for _ in range(500)).encode()
    for order in (1, 2, 3):
        whole = Counter(x for some in importance.features(text, order) for x in some.tolist())
        parts = Counter(x for some in importance.features(text, order, 7) for x in some.tolist())
        assert whole == parts
    _, expected = grams(text.decode())
    assert Counter(zlib.crc32(g.encode()) for g in expected) == Counter(
        x for some in importance.features(text, 2, 30) for x in some.tolist()
    )


def test_draw_equals_brute_force(spark):
    rng = random.Random(2)

    def text():
        return " ".join(f"{rng.choice('ABcdé')}{rng.randrange(40)}{rng.choice('.,-_ ')}" for _ in range(rng.randrange(1, 60)))

    docs = [(i, text()) for i in range(120)] + [(200, None), (201, ""), (202, "?!"), (None, text() * 3)]
    docs += [(5, docs[5][1]), (7, "x " * 5000), (300, "Ä ä " * 20)]
    target = [text() for _ in range(20)] + [None, ""]
    frame = spark.createDataFrame([(*d, "extra") for d in docs], "doc_id long, text string, score string")
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, n_words int")
    got = importance.draw(importance.scores(frame, bench))
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    as_rows = Counter(tuple(r) for r in got.collect())
    assert as_rows == Counter(map(tuple, brute(docs, target)))
    chosen = importance.resample(frame, bench)
    assert chosen.columns == frame.columns and chosen.count() == sum(r[-1] is not None for r in as_rows)


def test_whole_documents_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    got = importance.draw(importance.scores(docs, bench))
    expected = brute([tuple(r) for r in docs.collect()], [r["text"] for r in bench.collect()])
    assert Counter(tuple(r) for r in got.collect()) == Counter(map(tuple, expected))


@pytest.mark.parametrize("rows", [[], [(1, "a b c")]])
def test_small_and_empty_tables(spark, rows):
    docs = store(spark.createDataFrame(rows, "doc_id long, text string"), "few")
    empty = spark.createDataFrame([], "text string")
    got = importance.draw(importance.scores(docs, empty)).collect()
    assert [(r["doc_id"], r["rank"]) for r in got] == [(i, None) for i, _ in rows]
    assert importance.resample(docs, empty).count() == 0
