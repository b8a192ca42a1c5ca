"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lakefold.llm import queries, runs
from lakefold.llm.words import mix

SMALL = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, times=4):
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e - i + q >= max(least, times * q):
                found.setdefault((i, e - i + q), q)  # a smaller period with the same ends came first
            i = e
    return sorted((s, length, q) for (s, length), q in found.items())


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    gone = set()
    for s, length, q in found:
        gone.update(range(s + q, s + length))
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_many_shapes(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(draw.randint(0, 12)):
        words = []
        for _ in range(draw.randint(0, 6)):
            stem = [draw.randint(0, draw.choice([1, 2, 40])) for _ in range(draw.randint(1, 9))]
            words += (stem * draw.randint(1, 7))[:draw.randint(1, 50)]
            words += [draw.randint(0, 99) for _ in range(draw.randint(0, 4))]
        texts.append(words)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    symbols = mix(np.array([w for t in texts for w in t], np.uint64) + np.uint64(1))
    got = runs.find_runs(symbols, first)
    assert list(zip(*map(list, got))) == [(i, *r) for i, t in enumerate(texts) for r in brute(t)]


def test_extensions_of_all_places():
    draw = random.Random(3)
    words = [draw.randint(0, 2) for _ in range(60)] + [1] * 40 + [0, 1, 2] * 15
    padded = mix(np.array([100, *words, 101], np.uint64))
    fence = np.zeros(len(padded), bool)
    fence[[0, -1]] = True
    grammar = runs.Grammar(padded, fence)
    assert len(grammar.names[-1]) < 8 and len(grammar.up) > 4
    x, y = (a.ravel() for a in np.meshgrid(np.arange(1, len(words) + 1), np.arange(1, len(words) + 1)))
    x, y = x[x != y], y[x != y]
    after, before = grammar.forward(x, y), grammar.backward(x, y)
    listed = padded.tolist()
    for i, j, f, b in zip(x.tolist(), y.tolist(), after.tolist(), before.tolist()):
        assert listed[i:i + f] == listed[j:j + f] and listed[i + f] != listed[j + f]
        assert listed[i - b:i] == listed[j - b:j] and listed[i - b - 1] != listed[j - b - 1]


def test_long_texts_are_whole():
    n = 200_000
    symbols = mix(np.tile(np.arange(7, dtype=np.uint64), n // 7 + 1)[:n])
    symbols[150_000] = mix(np.array([99], np.uint64))[0]
    got = runs.find_runs(symbols, np.array([0, n]))
    assert list(zip(*map(list, got))) == [(0, 0, 150_000, 7), (0, 150_001, n - 150_001, 7)]


def test_query_on_edge_rows(spark, edge, empty):
    rows = [tuple(r) for r in runs.run_report(edge).collect()]
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(rows, key=order) == sorted((expected(r.doc_id, r.text) for r in edge.collect()), key=order)
    assert any(r[0] == 18 and r[1:6] == (1, 0, 12, 1, 12000) for r in rows)
    assert runs.run_report(empty).count() == 0


def test_query_on_documents(spark, documents):
    got = {r.doc_id: tuple(r) for r in queries.op11_recompression_runs(spark, SMALL).collect()}
    want = {r.doc_id: expected(r.doc_id, r.text) for r in documents.collect()}
    assert got == want
    assert sum(r[1] > 0 for r in want.values()) > 10


def test_texts_and_runs(spark):
    df = spark.createDataFrame([("a", "x  y\nx y x y\tx y z"), ("b", None)], "name string, body string")
    got = {r.name: r for r in runs.periodic_runs(df, "name", "body").collect()}
    assert got["a"].collapsed == "x y z" and [tuple(r) for r in got["a"].runs] == [(0, 8, 2)]
    assert got["b"].collapsed == "" and got["b"].runs == []
    near = {r.name: r for r in runs.periodic_runs(df, "name", "body", least=4, times=2).collect()}
    assert [tuple(r) for r in near["a"].runs] == [(0, 8, 2)]
