"""Personal data by fixed patterns and a skip-chain conditional random field.

Base kinds (e-mail, IP, card, phone) are found by patterns, leftmost and without
overlaps.  A pattern loses what its greedy match spoils (a card number behind
another number), and what is written in another way than it asks for (an address
with `(at)`, a phone number that was given with its country code before).  The
field finds those again.

Tokens are numbers (with the signs inside them) and whatever surrounds an at-sign;
words between them bear no label, so the chain falls into pieces of tokens with
nothing but blanks or signs between.  A token's label is none, or the begin or the
inside of a kind.  Token scores are sums of learned weights of features (shape,
number of digits, checksum, words around), and neighbours share learned
transitions.  Skip edges join tokens of one document, however far apart, that are
equal or similar (the same digits, the same last digits, the same address or local
part): all tokens of such a group touch one shared variable, the kind of the
group, with learned potentials, so a group of n tokens has n edges and no pairs
are made.  Loopy message passing, ROUNDS rounds over all edges at once, gives
marginals; a token that its begin or inside labels make likely enough (SURE) is
part of a span.  Spans of the field that no base span of that kind touches are
added; base spans stay.

Training: the tokens of about SAMPLE_DOCS documents, drawn by a hash of the id, at
most SAMPLE_TOKENS from each; tokens in base spans have their kind, others none,
and tokens that a spoiled match hides (they would match alone) have no label and
teach nothing.  Weights are fitted by gradient steps on the likelihood, with
marginals from the same message passing.

Defined results: a null or empty text has no spans; texts are scanned whole,
however long; the same span found twice is one; repeated rows give repeated
results; without any base span in the sample nothing is learned and nothing
added; an empty table gives an empty one; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import blocks

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")  # a match that begins inside a run of digits would be one of the run
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

NUMBER = re.compile(r"(?<![A-Za-z0-9])(?:\+|\(\+?)?[0-9]++(?:[().-]{1,2}[0-9]++)*+\)?(?![A-Za-z0-9@])")
AT = re.compile(r"\x20?[\[(]at[\])]\x20?|@", re.I)
HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]+)*", re.I)
DOT = re.compile(r"\x20?[\[(]dot[\])]\x20?", re.I)
GAP = re.compile(r"[\x20\t().\-/]{0,3}")   # what may stand between neighbours of a chain
WORD = re.compile(r"[^\W\d_]+")

SAMPLE_DOCS = 20_000
SAMPLE_TOKENS = 64
BUCKETS = 1 << 12    # hashed features
LABELS = 1 + 2 * len(KINDS)   # none; begin and inside of each kind
GROUPS = 1 + len(KINDS)       # kinds of a group of similar tokens
ROUNDS = 8
STEPS = 60
RATE = 0.3
SHRINK = 1e-3
AGREE = 1.0          # score of agreement with a group before anything is learned
SURE = 0.9
AROUND = 24          # characters before and after a token whose words are features
KIND_OF = np.array([0] + [1 + k for k in range(len(KINDS)) for _ in (0, 1)])


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match of the e-mail pattern: around each at-sign that no match holds yet."""
    pos, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        pos = m.end() if m else at + 1
        if m:
            yield start, pos
        at = text.find("@", pos)


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, end, kind number, whether it passes) of the matches of each kind."""
    for a, b in _emails(text):
        yield a, b, 0, True
    for m in IP.finditer(text):
        yield m.start(), m.end(), 1, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            yield m.start(), m.end(), 2, 12 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield m.start(), m.end(), 3, 9 <= len(_digits(m.group())) <= 15


def _in_order(spans) -> list[tuple[int, int, int]]:
    return sorted(set(spans), key=lambda s: (s[0], s[2], s[1]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base kinds, in order."""
    return _in_order((a, b, k) for a, b, k, good in matches(text) if good)


def tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, plain form) of the tokens of a text, in order."""
    found, pos = [], 0
    if "@" in text or "at)" in text.lower() or "at]" in text.lower():
        for m in AT.finditer(text):
            a = m.start()
            while a > pos and text[a - 1] in LOCAL:
                a -= 1
            host = HOST.match(text, m.end())
            pos = host.end() if host else m.end()
            if host and a < m.start():
                found.append((a, pos, text[a:m.start()] + "@" + DOT.sub(".", host.group())))
    taken = list(found)
    for m in NUMBER.finditer(text):
        while taken and taken[0][1] <= m.start():
            taken.pop(0)
        if not taken or m.end() <= taken[0][0]:
            found.append((m.start(), m.end(), m.group()))
    return sorted(found)


def _bucket(*parts) -> int:
    h = 2166136261
    for c in "\x1f".join(map(str, parts)).encode():
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return 1 + h % (BUCKETS - 1)  # 0 is a feature that every token has


def features(text: str, token: tuple[int, int, str]) -> list[int]:
    a, b, plain = token
    digits = _digits(plain)
    shape = re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 20)) + "d", re.sub(r"[A-Za-z]+", "a", plain)) if "@" not in plain else ""
    if "@" in plain:
        local, host = plain.split("@", 1)
        kind = ("mail", bool(local), "." in host)
    elif len(digits) >= 12 and "." not in plain:
        kind = ("long", len(digits) <= 19 and luhn(digits))
    elif plain.count(".") == 3 and len(digits) + 3 == len(plain):
        kind = ("quad", all(int(p) <= 255 for p in plain.split(".") if len(p) < 9) and max(map(len, plain.split("."))) <= 3)
    else:
        kind = ("number", min(len(digits), 12))
    before = WORD.findall(text[max(0, a - AROUND):a].lower())
    after = WORD.findall(text[b:b + AROUND].lower())
    return [0, _bucket("kind", *kind), _bucket("shape", shape), _bucket("plus", plain.startswith("+"), plain.startswith("("), len(digits)),
            _bucket("before", before[-1] if before else ""), _bucket("after", after[0] if after else "")]


N_FEATURES = 6


def _similar(plain: str) -> list[str]:
    """Names of the groups that a token belongs to: by its whole form, and by what stays the same in variants of it."""
    if "@" in plain:
        address = plain.lower()
        return ["=" + address, "~" + address.split("@")[0]]
    digits = _digits(plain)
    if len(digits) < 6:
        return []
    return ["=" + digits] + (["~" + digits[-7:]] if 7 <= len(digits) < 16 and plain.count(".") < 3 else [])


@dataclass
class Graph:
    """Tokens of a block of texts: feature numbers, chain edges (token, next token) and skip edges (token, group)."""
    feature: np.ndarray
    chain: np.ndarray
    token: np.ndarray
    group: np.ndarray
    groups: int


def graph_of(texts: list[tuple[str, list[tuple[int, int, str]]]]) -> Graph:
    rows, chain, token, group, names = [], [], [], [], {}
    for number, (text, found) in enumerate(texts):
        seen: dict[str, list[int]] = {}
        for i, t in enumerate(found):
            at = len(rows)
            rows.append(features(text, t))
            if i and t[0] - found[i - 1][1] <= 3 and GAP.fullmatch(text, found[i - 1][1], t[0]):
                chain.append(at - 1)
            for name in _similar(t[2]):
                seen.setdefault(name, []).append(at)
        for name, members in seen.items():
            if len(members) > 1:  # a token alone has nobody to agree with
                names[number, name] = len(names)
                token += members
                group += [len(names) - 1] * len(members)
    return Graph(np.array(rows, np.int64).reshape(-1, N_FEATURES), np.array(chain, np.int64), np.array(token, np.int64),
                 np.array(group, np.int64), len(names))


@dataclass
class Model:
    weight: np.ndarray   # (buckets, labels)
    step: np.ndarray     # (labels, labels), from row to column
    first: np.ndarray    # (labels,): scores where a chain begins
    skip: np.ndarray     # (labels, groups)

    @staticmethod
    def blank() -> Model:
        return Model(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS),
                     AGREE * (KIND_OF[:, None] == np.arange(GROUPS)))


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=1, keepdims=True), 1e-300)


def marginals(m: Model, g: Graph) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens (labels), chain edges (labels x labels) and skip edges (labels x groups), by loopy message passing."""
    n, e, s = len(g.feature), len(g.chain), len(g.token)
    score = m.weight[g.feature].sum(axis=1)
    begins = np.ones(n, bool)
    begins[g.chain + 1] = False
    score[begins] += m.first
    own = np.exp(score - score.max(axis=1, keepdims=True)) if n else score
    go, share = np.exp(m.step), np.exp(m.skip)
    right, left = np.full((e, LABELS), 1 / LABELS), np.full((e, LABELS), 1 / LABELS)  # messages to the later and the earlier token
    up, down = np.full((s, GROUPS), 1 / GROUPS), np.full((s, LABELS), 1 / LABELS)     # to the group, and to the token
    for _ in range(ROUNDS):
        from_left, from_right, skips = np.ones((n, LABELS)), np.ones((n, LABELS)), np.zeros((n, LABELS))
        from_left[g.chain + 1], from_right[g.chain] = right, left
        np.add.at(skips, g.token, np.log(down))
        every = own * np.exp(skips)
        new_right = _scaled(((every * from_left)[g.chain]) @ go)
        new_left = _scaled(((every * from_right)[g.chain + 1]) @ go.T)
        new_up = _scaled(((every * from_left * from_right)[g.token] / down) @ share)
        total = np.zeros((g.groups, GROUPS))
        np.add.at(total, g.group, np.log(up))
        rest = total[g.group] - np.log(up)
        new_down = _scaled(np.exp(rest - rest.max(axis=1, keepdims=True)) @ share.T) if s else down
        right, left, up, down = new_right, new_left, new_up, new_down
    from_left, from_right, skips = np.ones((n, LABELS)), np.ones((n, LABELS)), np.zeros((n, LABELS))
    from_left[g.chain + 1], from_right[g.chain] = right, left
    np.add.at(skips, g.token, np.log(down))
    every = own * np.exp(skips)
    belief = _scaled(every * from_left * from_right)
    pair = (every * from_left)[g.chain][:, :, None] * go * (every * from_right)[g.chain + 1][:, None, :]
    pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)
    total = np.zeros((g.groups, GROUPS))
    np.add.at(total, g.group, np.log(up))
    rest = total[g.group] - np.log(up)
    rest = np.exp(rest - rest.max(axis=1, keepdims=True)) if s else rest
    link = ((every * from_left * from_right)[g.token] / down)[:, :, None] * share * rest[:, None, :]
    link /= np.maximum(link.sum(axis=(1, 2), keepdims=True), 1e-300)
    return belief, pair, link


def labels_of(text: str, found: list[tuple[int, int, str]]) -> list[int]:
    """Label number of each token by the base spans; -1 where a spoiled match hides what the token is."""
    spans = list(matches(text))
    out, last = [], None
    for a, b, plain in found:
        hit = next((s for s in spans if s[3] and s[0] < b and a < s[1]), None)
        if hit is not None:
            out.append(1 + 2 * hit[2] + (hit is last))
        else:
            spoiled = any(not s[3] and s[0] < b and a < s[1] and (s[0], s[1]) != (a, b) for s in spans)
            out.append(-1 if spoiled or ("@" in plain and plain != text[a:b]) else 0)
        last = hit
    return out


def fit(g: Graph, label: np.ndarray) -> Model:
    """Adagrad on the likelihood of the labelled tokens, all at once."""
    m = Model.blank()
    known = label >= 0
    truth = np.zeros((len(label), LABELS))
    truth[np.flatnonzero(known), label[known]] = 1
    params = {"weight": m.weight, "step": m.step, "first": m.first, "skip": m.skip}
    blank = vars(Model.blank())
    past = {name: np.full(p.shape, 1e-2) for name, p in params.items()}
    begins = np.ones(len(label), bool)
    begins[g.chain + 1] = False
    both = known[g.chain] & known[g.chain + 1]
    sure = known[g.token]
    seen = np.zeros((g.groups, LABELS))
    np.add.at(seen, g.group[sure], truth[g.token[sure]])
    kinds = np.zeros((g.groups, GROUPS))
    np.add.at(kinds.T, KIND_OF, seen.T)
    kind = np.zeros((g.groups, GROUPS))  # a group is of the kind that most of its tokens have
    if g.groups:
        kind[np.arange(g.groups), kinds.argmax(axis=1)] = 1
    n = max(1, int(known.sum()))
    for _ in range(STEPS):
        belief, pair, link = marginals(m, g)
        off = (truth - belief) * known[:, None]
        weight = np.zeros_like(m.weight)
        for j in range(N_FEATURES):
            np.add.at(weight, g.feature[:, j], off)
        grad = {"weight": weight, "first": off[begins].sum(axis=0),
                "step": (truth[g.chain][:, :, None] * truth[g.chain + 1][:, None, :] - pair)[both].sum(axis=0),
                "skip": (truth[g.token][:, :, None] * kind[g.group][:, None, :] - link)[sure].sum(axis=0)}
        for name, p in params.items():
            d = grad[name] / n * 100 - SHRINK * (p - blank[name])
            past[name] += d * d
            p += RATE * d / np.sqrt(past[name])
    return m


def found_spans(found: list[tuple[int, int, str]], belief: np.ndarray, linked: set[int]) -> list[tuple[int, int, int]]:
    """Spans of the field: likely tokens of one kind; a token whose inside label is the likelier goes on with
    the span before it.  `linked` has the tokens that a chain edge joins to the next."""
    out: list[tuple[int, int, int]] = []
    open_kind = None
    for i, (a, b, _) in enumerate(found):
        share = belief[i, 1::2] + belief[i, 2::2]
        k = int(share.argmax())
        if share[k] < SURE:
            open_kind = None
            continue
        if open_kind == k and i - 1 in linked and belief[i, 2 + 2 * k] > belief[i, 1 + 2 * k]:
            out[-1] = (out[-1][0], b, k)
        else:
            out.append((a, b, k))
        open_kind = k
    return out


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """A model from a bounded sample of the documents; None if no base span is in it."""
    n = docs.count()
    rate = min(1.0, SAMPLE_DOCS / max(1, n))
    draw = F.pmod(F.xxhash64(key, F.length(text)), F.lit(1 << 20)) / float(1 << 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            out = []
            for x in block.column(0).to_pylist():
                found = tokens(x)[:SAMPLE_TOKENS]
                if not found:
                    continue
                g = graph_of([(x, found)])
                out.append((g.feature.ravel().tolist(), g.chain.tolist(), g.token.tolist(), g.group.tolist(), labels_of(x, found)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.list_(pa.int64())) for i in range(5)],
                                             names=["feature", "chain", "token", "group", "label"])

    parts = ", ".join(f"{c} array<bigint>" for c in ("feature", "chain", "token", "group", "label"))
    rows = (docs.filter((draw < rate) & F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text")).mapInArrow(run, parts)
            .limit(2 * SAMPLE_DOCS).toArrow())  # twice the expected number at most
    lists = sorted(zip(*(rows.column(i).to_pylist() for i in range(5))))
    if not any(x > 0 for r in lists for x in r[4]):
        return None
    at, groups, chain, token, group = 0, 0, [], [], []
    for r in lists:
        chain += [at + i for i in r[1]]
        token += [at + i for i in r[2]]
        group += [groups + i for i in r[3]]
        at, groups = at + len(r[4]), groups + (max(r[3]) + 1 if r[3] else 0)
    feature = np.array([x for r in lists for x in r[0]], np.int64).reshape(-1, N_FEATURES)
    g = Graph(feature, np.array(chain, np.int64), np.array(token, np.int64), np.array(group, np.int64), groups)
    return fit(g, np.array([x for r in lists for x in r[4]], np.int64))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def label_texts(texts: list[str], model: Model | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(x) for x in texts]
    if model is None:
        return [(b, b) for b in base]
    found = [tokens(x) for x in texts]
    g = graph_of(list(zip(texts, found)))
    belief, _, _ = marginals(model, g)
    linked, at, out = set(g.chain.tolist()), 0, []
    for b, own in zip(base, found):
        joined = {i for i in range(len(own)) if at + i in linked}
        more = [s for s in found_spans(own, belief[at:at + len(own)], joined)
                if not any(x[2] == s[2] and x[0] < s[1] and s[0] < x[1] for x in b)] if own else []
        out.append((b, _in_order([*b, *more])))
        at += len(own)
    return out


def find_personal_data(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, the number of base spans of each kind, `base_spans` and `spans` (kind:start:end by start, then kind,
    comma-joined)."""
    shared = docs.sparkSession.sparkContext.broadcast(model and vars(model))  # of fixed size
    df = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value) if shared.value else None
        for block in blocks(batches, "text"):
            rows = label_texts([x or "" for x in block.column(1).to_pylist()], m)
            counts = [pa.array([sum(s[2] == k for s in base) for base, _ in rows], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), *counts, pa.array([_joined(base) for base, _ in rows], pa.string()),
                 pa.array([_joined(spans) for _, spans in rows], pa.string())],
                names=["key", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])

    kind = df.schema["key"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return df.mapInArrow(run, f"key {kind}, {counts}, base_spans string, spans string").withColumnRenamed("key", key)


def personal_data_report(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    return find_personal_data(docs, train(docs)).select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")
