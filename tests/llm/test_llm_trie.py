"""The trie of rebuilt conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np

from lakefold.llm import queries, trie

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, depth int, k int, w string, part int, f1 string, child int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, own_members in members.items():
        words = len(WORD.findall(path[-1][1].decode())) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(own_members) - 1) * words
            leaves[path[:d]] += path not in children
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def check(spark, rows, parts=3):
    wide = [(*r, "x", 1, 2, "x", 3, "x", 4) for r in rows]
    found = trie.trie_report(spark.createDataFrame(wide, SCHEMA).repartition(parts))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_arithmetic():
    draw = random.Random(1)
    a, b = ([draw.randrange(trie.PRIME) for _ in range(500)] + [0, 1, trie.PRIME - 1] for _ in range(2))
    assert trie.multiply(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % trie.PRIME for x, y in zip(a, b)]
    u, v, w = ((draw.randint(0, 5), draw.randrange(trie.PRIME), draw.randrange(trie.PRIME), 3) for _ in range(3))
    assert trie.compose(trie.compose(u, v), w) == trie.compose(u, trie.compose(v, w))


def test_shapes(spark):
    draw = random.Random(5)
    rows = []
    for c in [*range(0, 130), -3, -20, -45, 10**12 + 7]:
        if c % 40 == 0 and draw.random() < 0.4:
            continue  # an absent base
        for t in range(draw.randint(1, 6)):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "a b", "", "c  d\te", "x y z"])))
    rows += [(7, None, None, None), (7, None, "user", None), (7, 2, "user", "a b"), (7, 2, "user", "a b"),  # nulls, ties, a repeated row
             (None, 0, "user", "left out"), (None, None, None, None)]
    rows += [(200, t, "user", f"turn {t % 7}") for t in range(160)]   # a long conversation, and one that repeats most of it
    rows += [(201, t, "user", f"turn {t % 7}") for t in range(150)]
    rows += [(c, t, "user", f"same {t}") for c in range(300, 420) for t in range(3)]  # copies
    check(spark, rows)


def test_one_conversation_over_all_ranges(spark):
    check(spark, [(20, t, "user", "w " * (t % 3)) for t in range(300)] + [(21, t, "user", "w " * (t % 3)) for t in range(40)], parts=8)


def test_turnless_and_empty(spark):
    alone = next(c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    check(spark, [(alone, 0, "user", "gone")])  # all its turns are skipped, and there is no base
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.trie_report(empty).count() == 0


def test_query_by_brute_force(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op12_monoid_trie(spark, SMALL).collect()) == brute(rows)
