import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfeed.llm import nearest, pitman_yor, sharding, toxicity

VECTORS = "vec_id long, embedding array<float>, entry string"


def exact(vectors, k, modulus):
    out = {}
    for q, x in vectors:
        if q % modulus == 0:
            scored = [(-float(np.dot(x, y)), i) for i, y in vectors if i != q]
            out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    centers = rng.standard_normal((12, 24)) * 2
    data = (centers[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 24))).astype(np.float32)
    data[:400] = data[0]
    rows = [(i, v.tolist(), "c") for i, v in enumerate(data)]
    found = nearest.search(spark.createDataFrame(rows, VECTORS), 20, k=10).collect()
    vectors = [(i, v.astype(float)) for i, v in enumerate(data)]
    expected = exact(vectors, 10, 20)
    got = {}
    for r in found:
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == expected.keys()
    hit = 0
    for q, ranked in got.items():
        assert sorted(ranked) == list(range(1, 11))
        for v, s in ranked.values():
            assert abs(s - float(np.dot(vectors[q][1], vectors[v][1]))) < 1e-9
        hit += len({v for v, _ in ranked.values()} & set(expected[q]))
    assert hit >= 0.9 * 10 * len(got)
    assert [got[0][i][0] for i in range(1, 11)] == expected[0]  # ties go to the smaller id


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")])]
    rows += [(6, [float("inf"), 1.0]), (7, [1.0]), (None, [1.0, 2.0]), (8, [-1.0, 0.5])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    found = nearest.search(frame, 20, k=5).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [
        (0, 1, 1, 1.0),
        (0, 2, 8, -1.0),
    ]
    assert nearest.search(frame.filter("false"), 20).count() == 0


def test_tree_moves_rows_only_into_what_grew(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"))
    eight, nine = sharding.tree(8), sharding.tree(9)
    heavy = sharding.tree(8, {3: 2.0})
    rows = sharding.assign(docs, eight)
    for name, leaves in (("grown", nine), ("heavy", heavy)):
        rows = sharding.assign(rows, leaves, shard=name)
    found = rows.collect()
    assert {r["grown"] for r in found if r["grown"] != r["shard"]} == {8}
    assert {r["heavy"] for r in found if r["heavy"] != r["shard"]} == {3}
    counts = Counter(r["heavy"] for r in found)
    assert all(abs(counts[s] / 4000 - (2 if s == 3 else 1) / 9) < 0.03 for s in range(8))
    # a change below one region moves nothing between the others
    assert all(r["heavy"] == r["shard"] or r["heavy"] == 3 for r in found)


def test_sharding_of_unusual_rows(spark):
    texts = [None, "", "é", "same", "same", "long " * 40_000]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)] + [(3, "same", "x")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    found = sharding.shard_documents(docs, 4, 5).collect()
    expected = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(docs.filter("false"), 4, 5).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(docs, [sharding.Leaf(0, 0, 0, 0.0)])


def test_numbering_in_many_buckets(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("shard"))
    found = sharding.number(rows, bucket_rows=7).collect()
    for s in range(3):
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shard_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = sharding.assign(docs, sharding.tree(16))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stirling_numbers_and_exact_draws():
    table = np.exp(pitman_yor.stirling(0.5, 5))
    assert np.allclose(table[3, 1:4], [0.75, 1.5, 1.0])
    rng = np.random.default_rng(0)
    full = pitman_yor.stirling(0.5)
    counts = np.array([1] * 10 + [3] * 20_000 + [500] * 5)
    drawn = pitman_yor.draw_tables(counts, np.full(len(counts), 2.0), 0.5, full, rng)
    weights = np.exp(full[3, 1:4]) * 2.0 ** np.arange(1, 4)
    shares = np.bincount(drawn[10:20_010], minlength=4)[1:] / 20_000
    assert np.allclose(shares, weights / weights.sum(), atol=0.02)
    assert (drawn[:10] == 1).all() and ((drawn >= 1) & (drawn <= counts)).all()


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    words = np.sort(rng.integers(3, 1 << 62, 30).astype(np.uint64))
    contexts = np.array([5, 9, 77], dtype=np.uint64)
    word_of = np.repeat(np.arange(30), 2)
    context = np.tile([0, 1], 30)
    part = pitman_yor.Part(0, words, contexts, word_of, context, rng.integers(1, 80, 60))
    part.customers = part.per_context(part.counts).astype(float)
    fixed = pitman_yor.Fixed(int(part.counts.sum()), 30, 0.7, 0.6)
    part.sweep(fixed, pitman_yor.Totals(part.per_context(part.tables).astype(float), 60.0, 30.0), 1, 1)
    tables = part.per_context(part.tables).astype(float)
    now = pitman_yor.Totals(tables, float(part.dishes.sum()), float(part.root_tables.sum()))
    for c in contexts:
        request = (words, np.array([c]), np.arange(30), np.zeros(30, int), None)
        unknown = (np.array([1 << 63], dtype=np.uint64), np.array([c]), np.zeros(1, int), np.zeros(1, int), None)
        total = part.predict(request, fixed, now).sum() + part.predict(unknown, fixed, now)[0]
        assert abs(total - 1) < 1e-9


def test_squeezed_numbers_and_gathered_pairs(monkeypatch, tmp_path):
    arrays = [np.array(x, dtype=np.uint64) for x in ([], [0, 0], [1, 255, 256, 1 << 63], [70_000] * 5)]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, pitman_yor.spread(pitman_yor.squeeze(*arrays)), strict=True))
    monkeypatch.setattr(pitman_yor, "PENDING", 50)
    rng, counts = random.Random(3), Counter()
    gathered, asked = pitman_yor.Gathering(), set()
    for number in range(30):
        texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(9)) for _ in range(4)]
        held = [rng.random() < 0.3 for _ in texts]
        tokens = [pitman_yor.text_hashes(t.encode()) for t in texts]
        batch = pitman_yor.Batch(list(range(4)), held, tokens)
        (one,) = batch.requests(1)
        gathered.add(one[1])
        for t, out in zip(tokens, held, strict=True):
            for before, word in zip([int(pitman_yor.BEGIN), *t[:-1].tolist()], t.tolist(), strict=True):
                context = before >> (64 - pitman_yor.CONTEXT_BITS)
                asked.add(context)
                counts[word, context] += not out
    gathered.save(f"{tmp_path}/part-0")
    part, _ = pitman_yor.Model(None, str(tmp_path), 1, 0).load(0)
    assert part.contexts.tolist() == sorted(asked)
    found = zip(part.words[part.word_of].tolist(), part.contexts[part.context].tolist(), part.counts.tolist(), strict=True)
    assert {(w, c): n for w, c, n in found} == {k: n for k, n in counts.items() if n}


def plain_seating(tokens, held, discount, root_discount, sweeps, burn_in, rng):
    """Customers seated one at a time: take one away, seat it again; the mean probability of each pair."""
    known = sorted({w for t, out in zip(tokens, held, strict=True) if not out for w in t})
    base = 1 / (len(known) + 1)
    tables, root = {}, {}  # customers at each table of a dish

    def root_probability(w):
        mine, everything = root.get(w, []), [n for v in root.values() for n in v]
        new = (1 + root_discount * len(everything)) * base
        return (sum(mine) - root_discount * len(mine) + new) / (1 + sum(everything))

    def probability(c, w):
        mine = tables.get((c, w), [])
        everything = [n for (x, _), v in tables.items() if x == c for n in v]
        own = sum(mine) - discount * len(mine)
        return (own + (1 + discount * len(everything)) * root_probability(w)) / (1 + sum(everything))

    def sit(seats, new, d):
        weights = [n - d for n in seats] + [new]
        at = rng.choices(range(len(weights)), weights)[0]
        if at == len(seats):
            seats.append(0)
        seats[at] += 1
        return seats[at] == 1

    def leave(seats):
        at = rng.choices(range(len(seats)), seats)[0]
        seats[at] -= 1
        if not seats[at]:
            del seats[at]
            return True
        return False

    def seat(c, w):
        total = sum(len(v) for (x, _), v in tables.items() if x == c)
        if sit(tables.setdefault((c, w), []), (1 + discount * total) * root_probability(w), discount):
            total = sum(len(v) for v in root.values())
            sit(root.setdefault(w, []), (1 + root_discount * total) * base, root_discount)

    pairs = [p for t, out in zip(tokens, held, strict=True) if not out for p in zip([None, *t[:-1]], t, strict=True)]
    for p in pairs:
        seat(*p)
    asked = {p for t in tokens for p in zip([None, *t[:-1]], t, strict=True)}
    mean = dict.fromkeys(asked, 0.0)
    for turn in range(sweeps):
        for c, w in pairs:
            if leave(tables[c, w]):
                leave(root[w])
            seat(c, w)
        if turn >= burn_in:
            for p in asked:
                mean[p] += probability(*p) / (sweeps - burn_in)
    return mean


def test_scores_are_near_those_of_a_plain_seating(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(12)], k=7)) for _ in range(24)] + ["w0 new w1"]
    held = [i % 6 == 5 or i == 24 for i in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = (F.col("doc_id") % 6 == 5) | (F.col("doc_id") == 24)
    found = {r["doc_id"]: r["score"] for r in pitman_yor.score(docs, out, burn_in=5, samples=10).collect()}
    tokens = [[*t.split(), ""] for t in texts]
    trained = [t for t, o in zip(tokens, held, strict=True) if not o]
    pairs = Counter(p for t in trained for p in zip([None, *t[:-1]], t, strict=True))
    kinds = Counter(pairs.values())
    dishes = Counter(Counter(w for _, w in pairs).values())
    discounts = pitman_yor.discount_of(kinds[1], kinds[2]), pitman_yor.discount_of(dishes[1], dishes[2])
    mean = plain_seating(tokens, held, *discounts, 60, 20, rng)
    for i, t in enumerate(tokens):
        exact = sum(math.log10(mean[p]) for p in zip([None, *t[:-1]], t, strict=True))
        assert abs(found[i] - exact) < 0.05 * len(t), (i, found[i], exact)


def test_scores_equal_the_contract(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "Of", "é", f"w{rng.randrange(40)}"]) for _ in range(60)) for _ in range(60)]
    texts += [None, "", texts[0], texts[0], "unknown1 unknown2", "the " * 50_000]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3, "doc_id")
    docs = docs.checkpoint()
    held = toxicity.bucket("doc_id", 7) == 2
    found = {r["doc_id"] or 0: r for r in pitman_yor.score(docs, held).collect()}
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").replace("Of", "of")) + [None] for i, t in enumerate(texts)}
    out = {i: zlib.crc32(str(i).encode() if i else b"") % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = found[i]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[i], len(ws), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in ws)
        assert abs(r["base_score"] - base) < 1e-6 * (1 + abs(base)) and r["score"] < 0
    assert sum(r["score"] for r in found.values()) > sum(r["base_score"] for r in found.values())
    assert pitman_yor.score(docs.filter("false"), held).count() == 0
    nothing = pitman_yor.score(docs.filter("doc_id < 3"), F.lit(True)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in nothing)
