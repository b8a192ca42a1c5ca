"""Quality rules, line dedup, mixing, language labels, BPE and secrets against brute force and on edge cases."""

import base64
import bz2
import gzip
import hashlib
import io
import itertools
import random
import re
import tarfile
import time
import urllib.parse
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lakefold.llm import bpe, langid, lines, mixing, quality, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# --- op3 ---

def measures(text):
    text = text or ""
    w = WORD.findall(text)
    rows = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(rows) - len(set(rows)), len(covered))


def test_quality_measures(edge):
    found = bag(quality.quality_report(edge), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = Counter()
    for r in edge.select("doc_id", "text").collect():
        m = measures(r.text)
        expected[(r.doc_id, *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
    assert found == expected


def test_quality_policies_and_ablation(documents, edge):
    entries = quality.ledger(documents).cache()
    for version in quality.POLICIES:
        names = quality.POLICIES[version]
        rows = entries.select("failed").collect()
        bit = {name: 1 << list(quality.RULES).index(name) for name in names}
        mask = quality.policy_mask(version)
        expected = {n: (sum(bool(r.failed & b) for r in rows), sum(r.failed & mask == b for r in rows)) for n, b in bit.items()}
        found = {r.rule: (r.n_failed, r.n_only_this) for r in quality.ablation(entries, version).collect()}
        assert found == {n: v for n, v in expected.items()} or not any(r.failed & mask for r in rows)
    good = quality.keep_good(edge)
    assert good.columns == edge.columns
    assert bag(good, "doc_id", "text") == bag(edge.join(quality.quality_report(edge).filter("kept").select("doc_id").distinct(), "doc_id"), "doc_id", "text") \
        + bag(quality.keep_good(edge.filter("doc_id IS NULL")), "doc_id", "text")


def test_quality_is_native(documents):
    plan = quality.quality_report(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan


# --- op4 ---

def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def left_by_force(rows):
    order = sorted({(d is not None, d or 0, th, t) for d, t, th in rows if t is not None}, key=lambda x: x[:3])
    first = {}
    for known, d, th, text in order:
        for no, raw in enumerate(text.split("\n")):
            line = raw.strip(" \t\n\x0b\x0c\r")
            if line:
                first.setdefault(line, (known, d, th, no))
    near = {a for a in first for b in first if first[b] < first[a] and len(a) >= lines.LEAST and len(b) >= lines.LEAST and within_one_edit(a, b)}
    out = Counter()
    for d, text, th in rows:
        if text is None:
            out[(d, 0, 0, hashlib.sha256(b"").hexdigest())] += 1
            continue
        keep, n, gone = [], 0, 0
        for no, raw in enumerate(text.split("\n")):
            line = raw.strip(" \t\n\x0b\x0c\r")
            n += bool(line)
            if line and (line in near or first[line] != (d is not None, d or 0, th, no)):
                gone += 1
            else:
                keep.append(raw)
        out[(d, n, gone, hashlib.sha256("\n".join(keep).encode()).hexdigest())] += 1
    return out


def hashed(df):
    return [tuple(r) for r in df.select("doc_id", "text", F.xxhash64("text")).collect()]


def test_lines(edge, spark):
    assert bag(lines.line_report(edge), "doc_id", "n_lines", "n_dropped", "left_sha256") == left_by_force(hashed(edge))
    draw = random.Random(6)
    base = ["".join(draw.choice("ab ") for _ in range(draw.randint(14, 22))) for _ in range(6)]
    rows = []
    for k in range(60):  # few letters: runs, insertions, deletions, replacements and transpositions
        made = []
        for _ in range(3):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 2)):
                at = draw.randrange(len(line))
                line[at:at + draw.randint(0, 1)] = [draw.choice("abc")] * draw.randint(0, 1)
            made.append("".join(line))
        rows.append((k, "\n".join(made)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert bag(lines.line_report(df), "doc_id", "n_lines", "n_dropped", "left_sha256") == left_by_force(hashed(df))


def test_one_edit_condition(spark):
    draw = random.Random(11)
    pairs = [("", ""), ("", "a"), ("ab", ""), ("é😀x", "é😀y"), ("é😀x", "😀x"), ("aaaa", "aaa"), ("ab", "ba")]
    for _ in range(1500):
        a = "".join(draw.choice("ab😀") for _ in range(draw.randint(0, 9)))
        b = list(a)
        for _ in range(draw.randint(0, 2)):
            at = draw.randint(0, len(b))
            b[at:at + draw.randint(0, 1)] = [draw.choice("abé")] * draw.randint(0, 1)
        pairs.append((a, "".join(b)))
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", F.expr(lines._one_edit("a", "b")).alias("near")).collect()
    assert all(r.near == within_one_edit(r.a, r.b) for r in rows)


def test_lines_of_a_million_characters(spark):
    long = "".join(random.Random(12).choices("abcdefgh ", k=1_000_000))
    rows = [(1, long), (2, long[:700_000] + "X" + long[700_001:]), (3, long[:10] + long[11:]), (4, long[:10] + "XY" + long[10:])]
    df = spark.createDataFrame(rows, "a bigint, b string")
    start = time.monotonic()
    near = df.join(df.select(F.col("a").alias("c"), F.col("b").alias("d")).filter("c = 1")).select("a", F.expr(lines._one_edit("b", "d")).alias("near"))
    assert {r.a: r.near for r in near.collect()} == {1: True, 2: True, 3: True, 4: False}
    assert time.monotonic() - start < 30


def test_least_length_of_near_lines(spark):
    df = spark.createDataFrame([(1, "short line"), (2, "short linf"), (3, "other")], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in lines.drop_repeated_lines(df).collect()}[2] == "short linf"
    assert {r.doc_id: r.text for r in lines.drop_repeated_lines(df, least=8).collect()} == {1: "short line", 2: "", 3: "other"}


def test_lines_keep_columns(edge):
    left = lines.drop_repeated_lines(edge)
    assert left.columns == edge.columns and left.count() == edge.count()


def test_variant_keys_agree_exactly_for_one_edit():
    draw = random.Random(8)
    for _ in range(400):
        a = "".join(draw.choice("ab") for _ in range(draw.randint(3, 9)))
        b = "".join(draw.choice("ab") for _ in range(draw.randint(3, 9)))
        (ka, ra), (kb, rb) = lines.variant_keys(a, True, True, True), lines.variant_keys(b, True, True, True)
        pairs = {(int(x), int(y)) for i, x in zip(ka, ra) for j, y in zip(kb, rb) if i == j}
        meets = (lines.PLACE, lines.PLACE) in pairs or (lines.OWN, lines.CUT) in pairs or (lines.CUT, lines.OWN) in pairs or a == b
        assert meets == within_one_edit(a, b), (a, b)


# --- op5 ---

def targets_by_force(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: Fraction((5, 2, 1)[k % 3]) for k, s in enumerate(names)}
    total, capped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return {s: float(2 * sizes[s] if s in capped else share[s]) for s in names}
        capped |= over


@pytest.mark.parametrize("table", ["edge", "documents"])
def test_mix(request, table):
    docs = request.getfixturevalue(table)
    found = mixing.mix_report(docs).collect()
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    goals = targets_by_force(sizes)
    assert len(found) == len(rows)
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in rows)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - goals[r.source]) <= 1e-6 * max(1, goals[r.source])
        assert r.taken == r.copies * r["size"] and r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    if table == "documents":
        assert all(abs(taken[s] - goals[s]) <= 0.05 * goals[s] + 20 for s in goals)
    assert bag(mixing.mix_report(docs), "doc_id", "size", "taken") == Counter((r.doc_id, r["size"], r.taken) for r in found)


def test_mixed_documents(edge):
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns
    copies = defaultdict(int)
    for r in mixing.mix(edge).collect():
        copies[r.doc_id, r.th] = max(copies[r.doc_id, r.th], r.copies)
    of = Counter((r.doc_id, r.th) for r in edge.select("doc_id", F.xxhash64("text").alias("th")).collect())
    found = Counter((r.doc_id, r.th) for r in mixed.select("doc_id", F.xxhash64("text").alias("th")).collect())
    assert found == Counter({k: copies[k] * n for k, n in of.items() if copies[k]})


def test_mix_is_native_and_newton_meets_targets(documents, spark):
    plan = mixing.mix_report(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    goals = spark.createDataFrame([("a", 1000, 37.0), ("b", 10, 20.0), ("c", 5, 0.0), (None, 0, 0.0)], "source string, source_size bigint, target double")
    for r in mixing.balance(goals).collect():
        assert abs(r.rate * r.source_size - r.target) < 1e-8


def test_mix_with_a_giant_document(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 32)
    rows = [(i, "a " * (20 + i % 30), source) for source, n, k in (("p", 3000, 0), ("q", 1500, 10000), ("r", 1500, 20000)) for i in range(k, k + n)]
    rows += [(50000, "b " * 9000, "q"), (50001, "b " * 9000, "r")]
    found = mixing.mix_report(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(2)).collect()
    for source in "pqr":
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 50
    assert all(0 <= r.copies <= mixing.MOST and r.taken == r.copies * r["size"] for r in found)


# --- op6 ---

def chain_by_force(scores, step):
    n, k = scores.shape
    post = np.zeros((n, k))
    for path in np.ndindex(*(k,) * n):
        p = np.exp(sum(scores[i, c] for i, c in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:])))
        for i, c in enumerate(path):
            post[i, c] += p
    return post / post.sum(axis=1, keepdims=True)


def test_posteriors():
    draw = np.random.default_rng(0)
    scores, step = draw.normal(size=(6, 3)) * 2, draw.normal(size=(3, 3))
    assert np.allclose(langid.posteriors(scores, np.array([0, 0, 6, 6]), step), chain_by_force(scores, step))
    long = draw.normal(size=(1000, 3)) * 4
    first = np.array([0, 1, 64, 65, 129, 129, 700, 1000])
    whole = langid._expectations(long, first[np.r_[True, np.diff(first) > 0]], step)[0]
    assert np.allclose(langid.posteriors(long, first, step), whole)


def test_posteriors_of_many_languages(monkeypatch):
    draw = np.random.default_rng(3)
    scores, step, first = draw.normal(size=(400, 5)), draw.normal(size=(5, 5)), np.array([0, 0, 7, 200, 201, 201, 400])
    few = langid.posteriors(scores, first, step)
    monkeypatch.setattr(langid, "LANGUAGES", 4)
    assert np.allclose(langid.posteriors(scores, first, step), few)


def test_expected_transitions():
    draw = np.random.default_rng(4)
    scores, step, first = draw.normal(size=(9, 3)), draw.normal(size=(3, 3)), np.array([0, 4, 5, 9])
    expected = np.zeros((3, 3))
    for a, b in zip(first[:-1], first[1:]):
        paths = list(itertools.product(range(3), repeat=b - a))
        weights = np.exp([sum(scores[a + i, x] for i, x in enumerate(p)) + sum(step[x, y] for x, y in zip(p, p[1:])) for p in paths])
        for p, w in zip(paths, weights / weights.sum()):
            for x, y in zip(p, p[1:]):
                expected[x, y] += w
    assert np.allclose(langid._expectations(scores, first, step)[1], expected)


def test_more_than_64_languages(spark):
    rows, draw = [], random.Random(11)
    for i in range(70):
        words = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        rows += [(100 * i + j, " ".join(draw.choices(words, k=60)), f"l{i:02d}") for j in range(6 if i < 64 else 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2)
    found = {r.doc_id: r.lang_pred for r in langid.language_report(docs).collect()}
    assert len({lang for _, _, lang in rows}) == 70 and all(found[i] == lang for i, _, lang in rows)


def test_language_of_held_out_documents(documents):
    found = langid.language_report(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    assert bag(langid.language_report(documents), "doc_id", "lang_pred", "score") == Counter((r.doc_id, r.lang_pred, r.score) for r in found)


def test_code_switched_text(spark, documents):
    by = {lang: [r.text for r in documents.filter(F.col("lang") == lang).orderBy("doc_id").limit(5).collect()] for lang in ("en", "fr")}
    text = " ".join(by["en"][1].split()[:40] + by["fr"][1].split()[:40])
    model = langid.train(documents)
    row = langid.label(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    assert {r["lang"] for r in row.runs} >= {"en", "fr"} and row.runs[0]["lang"] == "en" and row.runs[-1]["lang"] == "fr"


def test_language_edge_cases(edge, empty):
    found = {(r.doc_id): r for r in langid.language_report(edge).filter("doc_id IS NOT NULL").collect()}
    for i in (3, 4, 5, 12):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[10].lang_pred in {"en", "de", "fr"} and langid.language_report(edge).count() == edge.count()
    unlabelled = langid.language_report(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_numbers_are_no_letters(documents):
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang").unionByName(documents.sparkSession.createDataFrame(
        [(-1, "½ ² ① Ⅷ 12 _", None), (-2, "½ ² der", None), (-3, "ª", None)], "doc_id bigint, text string, lang string"))
    found = {r.doc_id: r.lang_pred for r in langid.language_report(texts).filter("doc_id < 0").collect()}
    assert found[-1] == "und" and found[-2] != "und" and found[-3] != "und"


# --- op8 ---

@pytest.fixture(scope="module")
def encoding():
    ranks = bpe.merges_of(bpe.read_ranks(RANKS)).ranks
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(edge, documents, encoding):
    for df in (edge, documents):
        expected = Counter()
        for r in df.select("doc_id", "text").collect():
            ids = np.array(encoding.encode_ordinary(r.text or ""), "<u4")
            expected[(r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())] += 1
        assert bag(bpe.round_trip(df, RANKS, PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected


def test_encode_and_decode(edge):
    encoded = bpe.encode(edge, RANKS, PATTERN)
    both = bpe.decode(encoded, RANKS).join(edge.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").filter("doc_id <> 14").collect()
    assert both and all(bytes(r.decoded) == (r.text or "").encode() and len(r.ids) == 4 * r.n_tokens for r in both)


def test_bpe_of_odd_texts(encoding):
    merges = bpe.merges_of(bpe.read_ranks(RANKS))
    draw = random.Random(9)
    parts = ["a", "ab", "न्", "漢字", "😀", "é", "ß", "1", "½", "abab", "aaaa", "==", "the", "tion", "\x00"]
    pieces = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 40))).encode() for _ in range(3000)]
    ids, bounds = merges.encode_pieces(pieces)
    whole = tiktoken.Encoding("one", pat_str=r"(?s:.+)", mergeable_ranks=merges.ranks, special_tokens={})
    for k, p in enumerate(pieces):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == whole.encode_ordinary(p.decode())
        assert merges.ranks.get(p) is not None or merges.encode_alone(p) == ids[bounds[k]:bounds[k + 1]].tolist()


# --- op10 ---

SECRET = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


def test_base_secrets(edge):
    found = {r.doc_id: r for r in secrets.secret_report(edge).filter("doc_id IS NOT NULL").collect()}
    text = edge.filter("doc_id = 16").first().text
    spans = "assign:0:29,hex:9:29,access:31:51"
    assert (found[16].n_assign, found[16].n_access, found[16].n_hex, found[16].spans) == (1, 1, 1, spans) and text[31:35] == "AKIA"
    assert found[16].base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert found[3].base_sha256 == hashlib.sha256(b"").hexdigest() and found[4].spans == ""
    assert secrets.secret_report(edge).count() == edge.count()


@pytest.mark.parametrize("text, kinds", [
    ("PASSWORD: abcdefghijkl", ["assign"]), ("password: abcdefghijk", []), ("Kelvin toKen = abcdefghijklmn", []),
    ("api_key=0123456789ab", ["assign"]), ("AKIA" + "A" * 13, []), ("AKIA" + "A" * 14, ["access"]),
    ("0123456789abcde", []), ("0123456789abcdef", ["hex"]), ("secret: token=abcdefghijkl", ["assign"]),
])
def test_base_kinds(text, kinds):
    assert [secrets.KINDS[k] for _, _, k in secrets.base_spans(text)] == kinds


@pytest.mark.parametrize("hide", [
    lambda s: urllib.parse.quote(s, safe=""), lambda s: "".join(f"%{c:02X}" for c in s.encode()),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in s), lambda s: "".join(f"\\x{ord(c):02x}" for c in s),
    b64, lambda s: b64(b64(s)), lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    lambda s: b64(gzip.compress(s.encode())), lambda s: b64(zlib.compress(s.encode())), lambda s: urllib.parse.quote(b64(b64(s)), safe=""),
    lambda s: b64(zlib.compress(b64(gzip.compress(s.encode())).encode())), lambda s: b64(gzip.compress(zlib.compress(s.encode()))),
])
def test_hidden_secrets_map_to_their_place(hide):
    hidden = hide(SECRET)
    text = "é before " + hidden + " after"
    base, spans = secrets.scan(text)
    assert set(base) <= set(spans)
    a, b, _ = next(s for s in spans if s[2] == 0)
    assert a >= 9 and b <= 9 + len(hidden) and b - a > len(hidden) // 2


def wrapped(data, width=76, end="\n"):
    line = b64(data)
    return end.join(line[i:i + width] for i in range(0, len(line), width))


RANDOM_WORDS = " ".join("".join(random.Random(i).choices("abcdefghijklmnop", k=7)) for i in range(200))


@pytest.mark.parametrize("hidden", [
    wrapped("x" * 30 + SECRET), wrapped("x" * 30 + SECRET, 64, "\r\n"), wrapped("x" * 30 + SECRET, 20, "\n    "), wrapped(SECRET, 10),
    wrapped(gzip.compress((RANDOM_WORDS + SECRET).encode())), wrapped(bz2.compress((RANDOM_WORDS + SECRET).encode()), 64),
    "-----BEGIN CERTIFICATE-----\n" + wrapped(zlib.compress((RANDOM_WORDS + SECRET).encode()), 64) + "\n-----END CERTIFICATE-----",
    *("https://h.com/cb/" + "y" * i + "/" + b64(SECRET) for i in range(4)), "auth_" + b64(SECRET), "x-" + b64(SECRET), "/x/" + b64(gzip.compress(SECRET.encode())),
    "/v1/" + b64(zlib.compress(SECRET.encode())), b64(SECRET).rstrip("=") + "/tail", "ab" + b64(SECRET + "12").rstrip("=") + "abc",
])
def test_wrapped_and_glued_base64(hidden):
    text = "é before " + hidden + " after"
    _, spans = secrets.scan(text)
    assert {k for _, _, k in spans} == {0, 2}
    assert all(9 <= a < b <= 9 + len(hidden) for a, b, _ in spans)


def tar(data):
    file = io.BytesIO()
    with tarfile.open(fileobj=file, mode="w") as out:
        entry = tarfile.TarInfo("settings.ini")
        entry.size = len(data)
        out.addfile(entry, io.BytesIO(data))
    return file.getvalue()


@pytest.mark.parametrize("hidden", [
    b"\xac\xed\x00\x05sr" + SECRET.encode() + b"\x00\xff\x80", bytes(range(128, 256)) * 20 + SECRET.encode(), b"\x00" * 3000 + SECRET.encode(),
    SECRET.encode("utf-16"), SECRET.encode("utf-16-le"), SECRET.encode("utf-16-be"), b"\xff\x01" + SECRET.encode("utf-16-be") + b"\x80",
    gzip.compress(tar(SECRET.encode())), gzip.compress(SECRET.encode("utf-16")), bz2.compress(b"\xff" * 50 + SECRET.encode()),
    b64(SECRET).encode("utf-16"), gzip.compress(b"\0" * 5000 + b64(SECRET).encode()),
])
def test_secrets_among_other_bytes(hidden):
    text = "é before " + b64(hidden) + " after"
    _, spans = secrets.scan(text)
    assert {k for _, _, k in spans} == {0, 2}
    assert all(9 <= a < b <= len(text) - 6 for a, b, _ in spans)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress])
@pytest.mark.parametrize("escape", [
    lambda d: "".join(f"%{c:02X}" for c in d), lambda d: urllib.parse.quote(d), lambda d: "".join(f"\\x{c:02x}" for c in d),
    lambda d: repr(d), lambda d: "".join(f"\\u{c:04x}" for c in d), lambda d: urllib.parse.quote("".join(f"\\x{c:02x}" for c in d)),
])
def test_escaped_streams(pack, escape):
    hidden = escape(pack((RANDOM_WORDS + SECRET).encode()))
    text = "é before " + hidden + " after"
    _, spans = secrets.scan(text)
    assert {k for _, _, k in spans} == {0, 2}
    assert all(9 <= a < b <= 9 + len(hidden) for a, b, _ in spans)


def test_escaped_utf16():
    assert {k for _, _, k in secrets.scan("".join(f"%{c:02X}" for c in SECRET.encode("utf-16")))[1]} == {0, 2}


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress])
@pytest.mark.parametrize("gap", [b"", b"\0" * 40])
def test_all_members_of_a_stream(pack, gap):
    cut = SECRET.encode()[:20], SECRET.encode()[20:]
    data = pack(b"first ") + gap + pack(b"") + pack(b"second " + cut[0]) + gap + pack(cut[1])
    text = "see " + b64(data) + " end"
    assert {s for s in secrets.scan(text)[1]} == {(4, len(text) - 4, 0), (4, len(text) - 4, 2)}
    inner = b64(zlib.compress(data))
    assert {k for _, _, k in secrets.scan(inner)[1]} == {0, 2}


@pytest.mark.parametrize("encode", [b64, lambda d: wrapped(d, 64), lambda d: "".join(f"%{c:02x}" for c in d)])
def test_long_runs_in_long_streams(monkeypatch, encode):
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1000)
    monkeypatch.setattr(secrets, "OVERLAP", 50)
    draw = random.Random(5)
    words = " ".join("".join(draw.choices("ghijklmnop", k=6)) for _ in range(1500))
    for before in range(0, 900, 101):
        inner = encode(gzip.compress((words + " " + SECRET + " ").encode()))
        body = "w " * (before // 2) + "value: " + inner + " end" + " w" * 700
        assert len(inner) > 4000
        assert {k for _, _, k in secrets.scan(b64(zlib.compress(body.encode())))[1]} == {0, 2}


def test_wrapped_base64_maps_characters():
    line = wrapped("x" * 40 + SECRET, 64)
    _, spans = secrets.scan("> " + line)
    a, b = next((a, b) for a, b, k in spans if k == 0 and "\n" in line[a - 2:b - 2])
    joined = line[a - 2:b - 2].replace("\n", "")
    skip = len(line[:a - 2].replace("\n", "")) % 4
    assert SECRET[:-1].encode() in base64.b64decode("A" * skip + joined + "A" * (-(skip + len(joined)) % 4))


def test_nothing_hidden_nothing_found():
    for text in ("%2525252561 %zz \\u12", "QUJD" * 5000, "%41" * 20000, b64(bytes(range(256)) * 20), b64(gzip.compress(b"plain words only " * 1000))):
        base, spans = secrets.scan(text)
        assert base == spans == []


def test_long_streams_are_scanned_in_windows(monkeypatch):
    monkeypatch.setattr(secrets, "LAYER_BYTES", 4096)
    monkeypatch.setattr(secrets, "OVERLAP", 512)
    body = "word " * 3000 + SECRET + " word" * 3000
    _, spans = secrets.scan(b64(zlib.compress(body.encode())))
    assert {k for _, _, k in spans} == {0, 2}


def test_a_stream_that_holds_itself_ends(monkeypatch):
    monkeypatch.setattr(secrets, "_inflated", lambda pieces, first: iter([first]))
    assert secrets.scan(b64(b"\x1f\x8b\x08" + bytes(40)))[1] == []


def test_streams_in_long_streams(monkeypatch):
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1000)
    monkeypatch.setattr(secrets, "OVERLAP", 200)
    noise = "".join(random.Random(3).choice("abcdefgh ") for _ in range(20000))
    for pack in (bz2.compress, zlib.compress, gzip.compress):
        for outer in (zlib.compress, bz2.compress):
            assert {k for _, _, k in secrets.scan(b64(outer(pack((noise + " " + SECRET + " " + noise).encode()))))[1]} == {0, 2}


def test_base64_of_one_case():
    assert secrets.scan("see IEFLSUFBQUFBQUFCQUFDQUFEQUFF end")[1] == [(5, 32, 1)]


def peeled_by_force(text):
    while True:
        before = text
        for one_level in (secrets._percent, secrets._escapes):
            text = (one_level(secrets.Layer(text)) or secrets.Layer(text)).text
        if text == before:
            return text


def test_escapes_of_escapes_to_the_end():
    draw = random.Random(5)
    units = ["%", "%", "\\", "x", "u", "2", "5", "4", "1", "0", "0", "c", "%41", "é", "%25", "\\u005c", "\\x25", "\\u0025", " "]
    for _ in range(20_000):
        text = "".join(draw.choices(units, k=draw.randint(1, 16)))
        layer = next(secrets._to_the_end(secrets.Layer(text)))
        assert layer.text == peeled_by_force(text), text
        assert len(layer.start) == len(layer.end) == len(layer.text)
        assert all(a < b for a, b in zip(layer.start, layer.end)) and (np.diff(layer.start) > 0).all()


def test_halves_and_bytes_from_deep_escapes():
    layer = next(secrets._to_the_end(secrets.Layer("a%2525C3%25A9\\u005cud83d\\ude00%FFz")))
    assert layer.text == "aé😀\ufffdz"
    assert (layer.start.tolist(), layer.end.tolist()) == ([0, 1, 13, 30, 33], [1, 13, 30, 33, 34])


@pytest.mark.parametrize("depth", [3, 40, 400])
def test_deep_escapes_hide_nothing(depth):
    hidden = "password%" + "25" * depth + "3DHidden0123456789xyz"
    text = f"left {hidden} right %{'25' * depth}41KIAABCDEFGHIJKLMNOP end"
    spans = secrets.scan(text)[1]
    assert (5, 5 + len(hidden), 0) in spans and (12 + len(hidden), len(text) - 4, 1) in spans


@pytest.mark.parametrize("chain", ["%" + "25" * 32_000 + "41", "\\" + "u005c" * 13_000 + "x41", "%5Cu0025" + "5Cu0025" * 9_000, "%" * 64_000 + "41"])
def test_long_chains_take_linear_time(chain):
    start = time.process_time()
    secrets.scan(chain)
    assert time.process_time() - start < 30


def test_nested_base64_takes_linear_time():
    data = b"password=Hidden0123456789xyz"
    while len(data) < 64_000:
        data = base64.b64encode(data)
    start = time.process_time()
    assert [kind for *_, kind in secrets.scan(f"see {data.decode()} end")[1]] == [0]
    assert time.process_time() - start < 30


def test_empty_tables(empty):
    assert quality.quality_report(empty).count() == 0 and quality.keep_good(empty).count() == 0
    assert quality.ablation(quality.ledger(empty)).count() == 0
    assert lines.line_report(empty).count() == 0
    assert mixing.mix_report(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert langid.language_report(empty).count() == 0
    assert bpe.round_trip(empty, RANKS, PATTERN).count() == 0
    assert secrets.secret_report(empty).count() == 0
