"""Personal data: base spans against the patterns as they are stated, the field against exact marginals and variants."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from lakefold.llm import pii, queries

SMALL = "/root/testdata/sf0.001"
STATED = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
          re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute(text):
    out = []
    for k, pattern in enumerate(STATED):
        for m in pattern.finditer(text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            good = [True, all(int(p) <= 255 for p in m.group().split(".")) if k == 1 else False,
                    12 <= len(digits) <= 19 and pii.luhn(digits), 9 <= len(digits) <= 15][k]
            if good:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in spans)


def card(seed, n=16):
    draw = random.Random(seed)
    body = "4" + "".join(str(draw.randrange(10)) for _ in range(n - 2))
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


@pytest.mark.parametrize("seed", range(60))
def test_base_spans_are_the_stated_ones(seed):
    draw = random.Random(seed)
    parts = ["a@b.c", "x.y@z", "@", "1.2.3.4", "300.1.1.1", "001.2.3.4", "1.2.3.4.5.6.7.8", "+1 (234) 555-1234", "+12", "-", " ", ".", "(", ")", "%d@e.f",
             card(seed), card(seed, 12), "4111 1111 1111 1112", "12345678901234567890123", "٣", "é", "\n", "+", "x" * 30, "7"]
    text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 40)))
    assert pii.base_spans(text) == brute(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_texts_in_time():
    began = time.monotonic()
    for text in ("x" * 300_000, "9" * 300_000, "x@" * 100_000, "1." * 100_000, "+1 (" * 50_000, "(" * 200_000 + "@"):
        pii.base_spans(text)
        pii.tokens(text)
    assert time.monotonic() - began < 30


def exact(m, g):
    """Marginals by all labellings, with the variable of each group summed out."""
    n = len(g.feature)
    score = m.weight[g.feature].sum(axis=1)
    begins = np.ones(n, bool)
    begins[g.chain + 1] = False
    score[begins] += m.first
    total = np.zeros((n, pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=n):
        w = np.exp(sum(score[i, y[i]] for i in range(n)) + sum(m.step[y[i], y[i + 1]] for i in g.chain))
        for k in range(g.groups):
            w *= sum(np.exp(sum(m.skip[y[t], z] for t in g.token[g.group == k])) for z in range(pii.GROUPS))
        for i in range(n):
            total[i, y[i]] += w
    return total / total.sum(axis=1, keepdims=True)


def test_message_passing_is_exact_without_loops():
    draw = np.random.default_rng(4)
    m = pii.Model(draw.normal(size=(pii.BUCKETS, pii.LABELS)), draw.normal(size=(pii.LABELS,) * 2), draw.normal(size=pii.LABELS),
                  draw.normal(size=(pii.LABELS, pii.GROUPS)))
    g = pii.Graph(draw.integers(0, pii.BUCKETS, (4, pii.N_FEATURES)), np.array([0, 2]), np.array([1, 3]), np.array([0, 0]), 1)
    assert np.allclose(pii.marginals(m, g)[0], exact(m, g), atol=1e-6)


@pytest.fixture(scope="module")
def model(spark):
    rows = []
    draw = random.Random(9)
    for i in range(600):
        noise = [draw.choice(["the", "and", "of", "total", "page", str(draw.randrange(10**draw.randint(1, 9)))]) for _ in range(30)]
        noise[draw.randrange(30)] = draw.choice([f"u{i}@host{i % 7}.example.com", f"+1 ({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)}",
                                                 card(i), ".".join(str(draw.randrange(256)) for _ in range(4)), "4111111111111112", "nothing"])
        if i % 3 == 0:  # the same again, far away
            noise += ["and"] * 20 + [max(noise, key=lambda w: len(re.sub("[^0-9@]", "", w)))]
        rows.append((i, " ".join(noise)))
    return pii.train(spark.createDataFrame(rows, "doc_id bigint, text string"))


def added(model, text):
    base, spans = pii.label_texts([text], model)[0]
    assert set(base) <= set(spans)
    return sorted((text[a:b], pii.KINDS[k]) for a, b, k in set(spans) - set(base))


def test_what_spoiled_matches_hide_is_found_again(model):
    text = f"the cards 1234567890123456 {card(3)} and of"
    assert pii.base_spans(text) == []
    assert added(model, text) == [(card(3), "card")]
    assert added(model, "the total of 1234567 and 4111111111111112 page 12") == []


def test_distant_variants_agree(model):
    far = "and the of " * 200
    assert added(model, f"mail ann.lee@host.example.com now {far} or ann.lee (at) host (dot) example (dot) com and") == [
        ("ann.lee (at) host (dot) example (dot) com", "email")]
    near = f"call +1 (234) 555-9876 now {far} and the 555-9876 of"
    apart = f"call +1 (234) 555-9876 now {far} and the 555-1111 of"
    number = lambda text, at: next(p for t, p in zip(pii.tokens(text), pii.marginals(model, pii.graph_of([(text, pii.tokens(text))]))[0])
                                   if t[0] > 100 and text[t[0]:t[1]] == at)
    assert number(near, "555-9876")[7:9].sum() > number(apart, "555-1111")[7:9].sum() + 0.1


def test_report_on_edge_rows(spark, edge, empty):
    rows = edge.collect()
    got = sorted((tuple(r) for r in pii.personal_data_report(edge).collect()), key=str)
    assert len(got) == len(rows)
    for doc_id, *counts, digest, spans in got:
        base = [brute(r.text) for r in rows if r.doc_id == doc_id]
        assert (counts, digest) in [([sum(s[2] == k for s in b) for k in range(4)], hashlib.sha256(joined(b).encode()).hexdigest()) for b in base]
    assert pii.personal_data_report(empty).count() == 0


def test_query_on_documents(spark, documents):
    rows = {r.doc_id: r for r in queries.op13_skip_chain_pii(spark, SMALL).collect()}
    for d in documents.collect():
        base, r = brute(d.text), rows.pop(d.doc_id)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        spans = [tuple(s.split(":")) for s in r.spans.split(",")] if r.spans else []
        assert {(pii.KINDS[k], str(a), str(b)) for a, b, k in base} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s[1]), pii.KINDS.index(s[0]), int(s[2])))
    assert not rows


def test_reruns_agree(spark, documents):
    a, b = (sorted(map(tuple, pii.personal_data_report(documents.repartition(n)).collect())) for n in (1, 7))
    assert a == b
