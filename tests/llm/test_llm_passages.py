"""Texts without the passages of earlier ones, against brute force."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lakefold.llm import passages
from lakefold.llm.suffixes import LEAST

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def left_by_force(rows):
    """Rows (doc_id, text, hash of the text) with the text that is left."""
    held, left, copies = {}, {}, {}
    order = sorted({(d is None, d or 0, xh, t) for d, t, xh in rows if t is not None}, key=lambda x: x[:3])
    for at in order:
        words = list(WORD.finditer(at[3]))
        if len(words) < LEAST:
            left[at] = at[3]
            continue
        key = tuple(m.group() for m in words)
        if key in copies:
            left[at] = ""
            continue
        copies[key] = at
        gone = set()
        for s in range(len(words) - LEAST + 1):
            if held.setdefault(key[s:s + LEAST], at) != at:
                gone.update(range(s, s + LEAST))
        ends = [m.start() for m in words[1:]] + [len(at[3])]
        left[at] = at[3][:words[0].start()] + "".join(at[3][m.start():e] for k, (m, e) in enumerate(zip(words, ends)) if k not in gone)
    return Counter((d, None if t is None else left[(d is None, d or 0, xh, t)]) for d, t, xh in rows)


def check(df):
    rows = [tuple(r) for r in df.select("doc_id", "text", F.xxhash64("text")).collect()]
    found = Counter((r.doc_id, r.text) for r in passages.drop_later_passages(df).select("doc_id", "text").collect())
    expected = left_by_force(rows)
    assert found == expected
    return found


def test_edge_rows(edge, empty):
    left = passages.drop_later_passages(edge)
    assert left.columns == edge.columns
    check(edge)
    assert passages.drop_later_passages(empty).count() == 0


def test_documents(documents):
    found = check(documents)
    assert sum(len(t or "") for _, t in found.elements()) < sum(r.n_chars or 0 for r in documents.select("n_chars").collect())


def test_passages_of_many_shapes(spark):
    draw = random.Random(8)
    shared = [[f"é{k}s{j}" for j in range(n)] for k, n in enumerate((49, 50, 51, 70, 120))]
    rows = []
    for k in range(60):
        words = []
        for _ in range(draw.randint(1, 4)):
            words += [f"w{draw.randint(0, 10**6)}" for _ in range(draw.randint(0, 30))]
            words += draw.choice(shared)[draw.randint(0, 3):]
        rows.append((draw.choice([k, k // 2, None]), draw.choice(["", " ", "\n"]) + draw.choice([" ", "\n", "  "]).join(words) + draw.choice(["", " "])))
    rows += rows[:5] + [(500 + k, rows[7][1]) for k in range(5)] + [(600, rows[7][1].replace(" ", "\t"))]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
