"""Repeated passages, fingerprints and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakefold.llm import fingerprint, graph, jaccard, suffixes
from lakefold.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- words and shingles ---

def test_words_match_the_pattern():
    texts = ["a b\tc\nd", None, "", "  x  ", "é\x0bß\x0c漢字 y\rz", "\x1cq\x85r\xa0s", "end"]
    for k in range(len(texts)):
        w = Words(pa.array(texts[k:]))
        assert list(w.n) == [len(WORD.findall(t or "")) for t in texts[k:]]
    w = Words(pa.array(["Aa bb", "aA BB", "Éa bb"]), lower=True)
    assert list(w.hash[:2]) == list(w.hash[2:4]) and w.hash[4] != w.hash[0]


def test_shingles_are_equal_exactly_when_the_words_are():
    texts = ["a b c d e f", "x a b c d e", "a b c", "a b c", "ab c d e f", ""]
    hashes, bounds = Words(pa.array(texts)).shingles(5)
    of = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert [len(s) for s in of] == [2, 2, 1, 1, 1, 0]
    assert of[0][0] == of[1][1] and of[2][0] == of[3][0]
    assert len({int(h) for s in of for h in s}) == 5


# --- op1 ---

def passages(rows):
    """(doc_id, spans) by comparing all stretches of 50 words; equal texts count as one document each."""
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    where = defaultdict(set)
    for d, (_, w) in enumerate(texts):
        for k in range(len(w) - 49):
            where[tuple(w[k:k + 50])].add(d)
    out = []
    for i, w in texts:
        spans = []
        for k in range(len(w) - 49):
            if len(where[tuple(w[k:k + 50])]) > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1][1] = k + 50
                else:
                    spans.append([k, k + 50])
        if spans:
            out.append((i, ",".join(f"{a}:{b}" for a, b in spans)))
    return sorted(out, key=str)


def found_passages(df):
    return sorted(((r.doc_id, r.spans) for r in suffixes.repeated_passages(df).collect()), key=str)


def test_passages(edge, documents):
    assert found_passages(edge) == passages(rows_of(edge))
    assert found_passages(documents) == passages(rows_of(documents))


def test_passages_of_every_length_and_neighbourhood(spark):
    """Passages of 45 to 80 words, nested in each other, with many documents that share only their middle."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    long = [word() for _ in range(120)]
    rows = []
    for k in range(160):
        a = draw.randint(0, 60)
        n = draw.randint(30, 60)
        rows.append((k, " ".join([word() for _ in range(draw.randint(5, 40))] + long[a:a + n] + [word() for _ in range(draw.randint(5, 40))])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found_passages(df) == passages(rows)


def test_every_stretch_holds_a_kept_start():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 2**63, 3000).astype(np.uint64)
    starts = suffixes.kept_starts(hashes)
    assert np.diff(np.r_[-1, starts]).max() <= suffixes.WINDOW


# --- op2 ---

def test_edit_report(edge, documents):
    for df in (documents, edge.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        rows = sorted(rows_of(df))
        found = {r.doc_id: r for r in fingerprint.edit_report(df).collect()}
        assert len(found) == len(rows)
        for k, (i, text) in enumerate(rows):
            text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
            new = fingerprint.edited(text, following)
            assert found[i].n_chars == len(text)
            assert found[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            own, other, succ = (fingerprint.sketches(pa.array([t]))[0] for t in (text, new, following))
            assert (found[i].fingerprint, found[i].edited_fingerprint) == (str(own), str(other))
            assert (found[i].near_edited, found[i].near_next) == (own.compare(other)[0], own.compare(succ)[0])


def test_edit_report_of_repeated_and_null_ids(edge):
    assert fingerprint.edit_report(edge).count() == edge.count()


def test_sketch_estimates_and_merge():
    draw = np.random.default_rng(2)
    universe = draw.integers(0, 2**63, 40_000).astype(np.uint64) * np.uint64(2)
    long, part = universe, universe[:900]
    a, b = fingerprint.Sketch.of(part), fingerprint.Sketch.of(long)
    assert a.compare(b)[1] == 1.0 and abs(b.compare(a)[1] - 900 / 40_000) < 0.01
    merged = fingerprint.Sketch.of(universe[:20_000]).merge(fingerprint.Sketch.of(universe[10_000:]))
    assert abs(merged.n - 40_000) < 2_000 and merged.compare(b)[0] > 0.99
    again = fingerprint.Sketch.read(str(a))
    assert again.n == a.n and list(again.kept) == list(a.kept)
    empty = fingerprint.Sketch.of(universe[:0])
    assert empty.compare(empty) == (1.0, 1.0) and empty.compare(a) == (0.0, 0.0)


# --- op9 ---

def components_by_force(rows):
    sets = []
    for _, text in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def found_components(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()), key=str)


def test_components(edge, documents):
    assert found_components(edge) == components_by_force(rows_of(edge))
    assert found_components(documents) == components_by_force(rows_of(documents))


@pytest.mark.parametrize("group, frequent", [(256, 32), (3, 4), (2, 1000)])
def test_components_of_large_groups(spark, monkeypatch, group, frequent):
    """Copies edited until many pairs lie about the threshold; small bounds send them through the cluster search."""
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "SEARCH_BLOCK", 16)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    draw = random.Random(3)
    rows = []
    for g in range(3):
        base = [f"w{g}x{draw.randint(0, 500)}" for _ in range(90)]
        for _ in range(70):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = f"e{draw.randint(0, 10**9)}"
            rows.append((len(rows), " ".join(copy)))
    shared = [f"s{k}" for k in range(40)]  # a passage in documents that are not alike
    rows += [(len(rows) + k, " ".join([f"u{k}y{j}" for j in range(60)] + shared)) for k in range(40)]
    rows += [(1000 + k, rows[5][1]) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found_components(df) == components_by_force(rows)


def test_bounds_of_the_filters():
    for na in range(1, 60):
        for nb in range(na, 60):
            least = jaccard.least_overlap(na, nb)
            assert 100 * least >= 75 * (na + nb - least) and 100 * (least - 1) < 75 * (na + nb - least + 1)


def heads_by_force(rows):
    """Rows (doc_id, text, hash of the text) that stay."""
    whole = components_by_id([(d, t) for d, t, _ in rows])
    best = {}
    for row, label in zip(rows, whole):
        if label is not None:
            at = (row[0] is None, row[0] or 0, row[2])
            best[label] = min(best.get(label, (at, row)), (at, row), key=lambda x: x[0])
    return sorted([row for _, row in best.values()] + [row for row, label in zip(rows, whole) if label is None], key=str)


def components_by_id(rows):
    """A component for each row, none if it has no word."""
    numbered = components_by_force([(k, t) for k, (_, t) in enumerate(rows)])
    return [label if n else None for _, n, label in sorted(numbered)]


def heads(df):
    return sorted((tuple(r) for r in jaccard.representatives(df).select("doc_id", "text", F.xxhash64("text")).collect()), key=str)


def test_representatives(edge):
    kept = jaccard.representatives(edge)
    assert kept.columns == edge.columns
    rows = [tuple(r) for r in edge.select("doc_id", "text", F.xxhash64("text")).collect()]
    found = heads(edge)
    assert found == heads_by_force(rows)
    ids = [d for d, *_ in found]
    assert ids.count(14) == 2 and ids.count(13) == 1  # two texts of one id, a repeated row
    assert 0 in ids and 1 not in ids and 17 not in ids and {3, 4, 5} <= set(ids)


def test_representatives_of_null_and_shared_ids(spark):
    text = [" ".join(f"w{k}x{j}" for j in range(60)) for k in range(4)]
    near = text[0].replace(" ", " added ", 1)
    rows = ([(None, text[0])] * 40 + [(None, near), (None, text[1]), (1, text[2]), (1, text[3]), (1, near + " x"), (2, text[2]), (2, text[3])]
            + [(7, text[1])] * 30 + [(None, None), (None, ""), (3, " "), (3, " ")])
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, n int").repartition(5)
    hashed = [tuple(r) for r in df.select("doc_id", "text", F.xxhash64("text")).collect()]
    assert heads(df) == heads_by_force(hashed)
    assert len(heads(df)) == 1 + 1 + 2 + 4
    again = jaccard.representatives(df.repartition(2)).collect()  # the same rows of equal ids and texts on every run
    assert sorted(map(str, again)) == sorted(map(str, jaccard.representatives(df).collect()))


def test_graph_components(spark):
    draw = random.Random(4)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(4000, 4100)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_empty_tables(empty):
    assert suffixes.repeated_passages(empty).count() == 0
    assert fingerprint.edit_report(empty).count() == 0
    assert fingerprint.fingerprints(empty).count() == 0
    assert jaccard.near_duplicates(empty).count() == 0
    assert jaccard.representatives(empty).count() == 0


def test_passages_that_repeat_themselves(spark):
    rows = [(k, " ".join(["of"] * (60 + 7 * k) + [f"w{k}x{j}" for j in range(k)])) for k in range(12)]
    rows += [(100 + k, " ".join((["a", "b", "c"] * 40)[k:k + 70 + k])) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found_passages(df) == passages(rows)
