import random
import zlib
from collections import Counter, defaultdict

import pytest

from loomfeed.llm import prefix_trie
from loomfeed.llm.common import store
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string, depth string, `key` int"


def nodes_of(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            said = (role or "", text or "")
            own[conv].append(((turn is not None, turn or 0), said))
    turns = {c: [s for _, s in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    members = defaultdict(list)
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        bytes_here = (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += bytes_here
            leaves[path[:d]] += not children[path]
    out = []
    for path, convs in members.items():
        ends = sorted(c for c in convs if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], brute.sha256(",".join(map(str, ends)))))
    return Counter(out)


def check(spark, rows, most):
    table = store(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), "conversations")
    got = prefix_trie.build(table, most)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for n, t in got.dtypes if n != "ends_sha256"} == {"bigint"}
    assert Counter(tuple(r) for r in got.collect()) == nodes_of(rows)


def conversations(rng, convs, longest, words):
    return [
        (c, None if t == 0 and rng.random() < 0.2 else t, rng.choice(["user", "assistant", None]), rng.choice(words))
        for c in convs
        for t in range(rng.randrange(1, longest))
    ]


@pytest.mark.parametrize("most", [0, 7, 2048])
def test_tries_equal_brute_force(spark, most):
    rng = random.Random(most)
    rows = conversations(rng, range(-12, 60), 12, ["a", "é", "", None])
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(10)]  # copies
    rows += [(c, t, "user", "same") for c in range(200, 215) for t in range(c - 195)]  # each the beginning of the next
    rows += [(300, t, "user", f"long {t}") for t in range(40)] + [(301, t, "user", f"long {t}") for t in range(30)]
    rows += [(400, 0, "system", "same"), (400, 0, "system", "same"), (None, 1, "user", "lost")]
    rng.shuffle(rows)
    check(spark, rows, most)


def test_ids_in_many_blocks_and_long_chains(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 50, 5) for t in range(23)]
    rows += [(c, t, "user", f"{c} {t}") for c in (1000, 1001) for t in range(20)]
    check(spark, rows, 8)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")], [(0, 0, "user", "x")], [(7, 0, "user", "x")], [(9, None, None, None)]])
def test_few_rows(spark, rows):
    check(spark, rows, 2048)


def test_whole_table_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = Counter(tuple(r) for r in prefix_trie.build(table, 64).collect())
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert got == nodes_of(rows)
