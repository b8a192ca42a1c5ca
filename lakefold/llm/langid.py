"""Language identification of words and documents with a linear-chain conditional random field.

Every word of a text gets a language by forward-backward, so code-switched texts
are labelled piece by piece; a document's language is the one with the largest
mean posterior over its words, weighted by their length, and that mean is its
score.

Word scores are sums of learned weights: prefixes and suffixes of 1 to 3 bytes,
byte trigrams (with word edges), and a lexicon, the share of each language among
all occurrences of the word in the training texts.  Transitions between
languages are learned with them.  Words are runs of ASCII letters and non-ASCII
bytes, lower-cased for A-Z and the Latin-1 letters.

Training: rows with a lang whose crc32(doc_id as text) mod 3 is not 1.  The
lexicon counts all their words.  Weights are fitted on a bounded sample: about
SAMPLE_DOCS documents of each language, chosen by a hash of the id, WINDOWS
stretches of at most WINDOW words from each, strung together in random order
into code-switched sequences.  Every lang of the training rows is learned; with
more than LANGUAGES of them, features share fewer buckets.

Defined results: a text that is null or has no letter is `und` with score 0; so
is every text if there is nothing to learn from; ties go to the language that
comes first by name; very long texts are labelled whole, in chunks whose
messages are passed on exactly; repeated rows agree; an empty table gives an
empty result; other columns than doc_id, text and lang (training only) are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import blocks
from lakefold.llm.words import run_hashes

LANGUAGES = 64      # with more of them, BUCKETS is halved for each doubling
SAMPLE_DOCS = 400
WINDOWS = 8
WINDOW = 16
EPOCHS = 6
BATCH = 64          # sequences in a step
SEGMENTS = 6        # stretches in a sequence
RATE = 0.2
BUCKETS = 1 << 16   # hashed features of each kind: the model's size does not grow with the corpus
LEAST_BUCKETS = 1 << 10
SLICE = 1 << 26     # feature weights gathered at a time
CHUNK = 64          # words of a chunk in forward-backward
BLOCK_TEXT = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hash(x: np.ndarray) -> np.ndarray:
    """Feature numbers of packed bytes."""
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int32)


def n_buckets(languages: int) -> int:
    n = BUCKETS
    while n > LEAST_BUCKETS and n * languages > BUCKETS * LANGUAGES:
        n //= 2
    return n


class Features:
    """Words of a column of texts and their feature numbers, below `size`."""

    def __init__(self, texts: pa.Array, size: int = BUCKETS):
        texts = texts.cast(pa.large_string()).fill_null("")
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and len(off) else np.zeros(0, np.uint8)
        off = off - off[0]
        data = _LOWER[data]
        latin = np.zeros(len(data), bool)
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[latin] += 0x20
        inside = _LETTER[data]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edge = off[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        start[edge] |= inside[edge]
        end[edge - 1] |= inside[edge - 1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, off)
        self.length = self.end - self.start
        self.own = np.flatnonzero(inside)  # the bytes of words
        self.at = np.cumsum(self.length) - self.length  # where each word's bytes begin among them
        wide = data.astype(np.uint64)
        before, after = np.zeros(len(data), np.uint64), np.zeros(len(data), np.uint64)
        before[1:], after[:-1] = wide[:-1], wide[1:]
        before[self.start] = 0
        after[self.end - 1] = 0
        self.trigrams = _hash((before << np.uint64(16) | wide << np.uint64(8) | after)[self.own] + np.uint64(1 << 40))
        affixes = []
        for k in (1, 2, 3):
            head = np.zeros(len(self.start), np.uint64)
            tail = np.zeros(len(self.start), np.uint64)
            for i in range(k):
                head = head << np.uint64(8) | np.where(i < self.length, wide[np.minimum(self.start + i, len(wide) - 1)] if len(wide) else 0, 0).astype(np.uint64)
                tail = tail << np.uint64(8) | np.where(i < self.length, wide[np.maximum(self.end - 1 - i, 0)] if len(wide) else 0, 0).astype(np.uint64)
            affixes += [_hash(head + np.uint64(k << 41)), _hash(tail + np.uint64(k << 44))]
        self.affixes = np.stack(affixes) if affixes else np.zeros((6, 0), np.int32)
        self.words = (run_hashes(wide + np.uint64(1), self.start, self.end) >> np.uint64(48)).astype(np.int32)
        if size < BUCKETS:
            self.trigrams, self.affixes, self.words = (x // (BUCKETS // size) for x in (self.trigrams, self.affixes, self.words))


@dataclass
class Model:
    languages: list[str]
    trigram: np.ndarray  # (buckets, languages)
    affix: np.ndarray
    lexicon: np.ndarray
    lexicon_weight: np.ndarray = field(default_factory=lambda: np.ones(1))
    bias: np.ndarray = None
    step: np.ndarray = None  # log transition weights, from row to column

    def scores(self, f: Features) -> np.ndarray:
        """(words, languages)."""
        if not len(f.start):
            return np.zeros((0, len(self.languages)))
        out = np.empty((len(f.start), len(self.languages)))
        ends, a = f.at + f.length, 0
        while a < len(out):  # as many words as their weights allow, one at least
            b = max(a + 1, int(np.searchsorted(ends, f.at[a] + SLICE // len(self.languages), side="right")))
            out[a:b] = np.add.reduceat(self.trigram[f.trigrams[f.at[a]:ends[b - 1]]], f.at[a:b] - f.at[a], axis=0)
            a = b
        for ids in f.affixes:
            out += self.affix[ids]
        return out + self.lexicon_weight * self.lexicon[f.words] + self.bias


def _scaled(x: np.ndarray, axes) -> np.ndarray:
    return x / np.maximum(x.max(axis=axes, keepdims=True), 1e-300)


def posteriors(scores: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Marginal probabilities of each word's language; text i has the rows first[i]:first[i + 1].

    Texts are cut into chunks.  The product of a chunk's step matrices carries
    messages over it; so messages go from chunk to chunk, and then inside all
    chunks at once.
    """
    n, k = scores.shape
    if k > LANGUAGES:
        return _by_words(scores, first, step)
    sizes = np.diff(first)
    chunks = -(-sizes // CHUNK)
    total = int(chunks.sum())
    if not total:
        return np.zeros((0, k))
    text = np.repeat(np.arange(len(sizes)), chunks)
    nth = np.arange(total) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    start = first[text] + nth * CHUNK
    length = np.minimum(CHUNK, first[text + 1] - start)
    index = start[:, None] + np.arange(CHUNK)
    valid = np.arange(CHUNK) < length[:, None]
    weight = np.exp(scores - scores.max(axis=1, keepdims=True))
    weight = np.where(valid[:, :, None], weight[np.minimum(index, n - 1)], 1.0)
    go = np.exp(step - step.max())
    eye = np.eye(k)
    product = np.broadcast_to(eye, (total, k, k)).copy()
    for t in range(CHUNK):
        on = valid[:, t]
        if not on.any():
            break
        moved = (product[on].reshape(-1, k) @ go).reshape(-1, k, k)
        if t == 0:
            moved[nth == 0] = eye  # nothing comes before a text's first word
        product[on] = _scaled(moved * weight[on, t][:, None, :], (1, 2))
    inward, outward = np.ones((total, k)), np.ones((total, k))
    heads = np.cumsum(chunks) - chunks
    for j in range(1, int(chunks.max())):
        at = heads[chunks > j] + j
        inward[at] = _scaled(np.einsum("ai,aij->aj", inward[at - 1], product[at - 1]), 1)
    for j in range(int(chunks.max()) - 2, -1, -1):
        at = heads[chunks > j + 1] + j
        outward[at] = _scaled(np.einsum("aij,aj->ai", product[at + 1], outward[at + 1]), 1)
    forward = np.empty((total, CHUNK, k))
    state = inward
    for t in range(CHUNK):
        moved = np.where((nth == 0)[:, None], 1.0, state @ go) if t == 0 else state @ go
        state = np.where(valid[:, t][:, None], _scaled(moved * weight[:, t], 1), state)
        forward[:, t] = state
    state = outward
    for t in range(CHUNK - 1, -1, -1):
        forward[:, t] *= state
        state = np.where(valid[:, t][:, None], _scaled((state * weight[:, t]) @ go.T, 1), state)
    out = forward[valid]
    return out / out.sum(axis=1, keepdims=True)


def _by_words(scores: np.ndarray, first: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The same for many languages, where step matrices of chunks would cost more than they spare: word by word,
    in all texts at once."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    sizes, start = sizes[order], first[:-1][order]
    longest = int(sizes.max()) if len(sizes) else 0
    on = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts with more words than that
    weight = np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores
    go = np.exp(step - step.max())
    out = np.empty_like(weight)
    state = None
    for t in range(longest):
        at = start[:on[t]] + t
        state = _scaled(weight[at] if t == 0 else (state[:on[t]] @ go) * weight[at], 1)
        out[at] = state
    state = np.ones((len(sizes), weight.shape[1]))  # rows of texts that are not yet begun from their end stay 1
    for t in range(longest - 1, -1, -1):
        at = start[:on[t]] + t
        out[at] *= state[:on[t]]
        state[:on[t]] = _scaled((state[:on[t]] * weight[at]) @ go.T, 1)
    return out / out.sum(axis=1, keepdims=True)


def _held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def _training(docs: DataFrame) -> DataFrame:
    return docs.filter(F.coalesce(~_held_out(), F.lit(True)) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def _lexicon(train: DataFrame, languages: list[str]) -> np.ndarray:
    """log of each language's share of a word's occurrences, by word bucket, from all training texts."""
    place, size = {name: i for i, name in enumerate(languages)}, n_buckets(len(languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(place), size), np.int64)
        for block in blocks(batches, "text"):
            f = Features(block.column(1), size)
            lang = np.array([place[x] for x in block.column(0).to_pylist()], np.int64)
            of = np.repeat(lang, np.diff(f.first))
            counts += np.bincount(of * size + f.words, minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(counts[lang, bucket])], names=["l", "w", "n"])

    rows = (train.select("lang", "text").mapInArrow(run, "l bigint, w bigint, n bigint")
            .groupBy("l", "w").agg(F.sum("n").alias("n")))
    counts = np.zeros((size, len(languages)))
    got = rows.toArrow()  # at most `size` rows a language
    counts[got["w"].to_numpy(), got["l"].to_numpy()] = got["n"].to_numpy()
    share = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * size)
    return np.log(share / share.sum(axis=1, keepdims=True) + 1e-3).astype(np.float32)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of words from each sampled document, at places fixed by a hash of the text."""
    for block in blocks(batches, "text"):
        langs, out = [], []
        for lang, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist()):
            words = text.split()
            draw = np.random.default_rng(len(text))
            for _ in range(min(WINDOWS, -(-len(words) // WINDOW))):
                at = int(draw.integers(0, max(1, len(words) - WINDOW + 1)))
                langs.append(lang)
                out.append(" ".join(words[at:at + int(draw.integers(2, WINDOW + 1))]))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.string())], names=["lang", "text"])


def _sample(train: DataFrame, sizes: dict[str, int]) -> pa.Table:
    rates = train.sparkSession.createDataFrame([(name, min(1.0, SAMPLE_DOCS / n)) for name, n in sizes.items()], "lang string, rate double")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    rows = train.join(F.broadcast(rates), "lang").filter(draw < F.col("rate"))  # a row for each language
    most = SAMPLE_DOCS * WINDOWS * len(sizes) * 2  # the expected number is half of that at most
    return rows.select("lang", "text").mapInArrow(_windows, "lang string, text string").limit(most).orderBy("lang", "text").toArrow()


def _fit(model: Model, sample: pa.Table) -> None:
    """Adagrad on the conditional likelihood of code-switched sequences."""
    k = len(model.languages)
    place = {name: i for i, name in enumerate(model.languages)}
    buckets = len(model.trigram)
    texts = sample["text"].combine_chunks()
    label = np.array([place[x] for x in sample["lang"].to_pylist()])
    draw = np.random.default_rng(7)
    params = {"trigram": model.trigram, "affix": model.affix, "lexicon_weight": model.lexicon_weight, "bias": model.bias, "step": model.step}
    past = {name: np.full(p.shape, 1e-2) for name, p in params.items()}
    useful = np.flatnonzero(np.concatenate([np.zeros(0, bool), *(np.diff(Features(texts[i:i + 4096]).first) > 0 for i in range(0, len(texts), 4096))]))
    for _ in range(EPOCHS):
        order = draw.permutation(useful)
        for b in range(0, len(order), BATCH * SEGMENTS):
            part = order[b:b + BATCH * SEGMENTS]
            f = Features(texts.take(pa.array(part)), buckets)
            seqs = [np.arange(i, min(i + SEGMENTS, len(part))) for i in range(0, len(part), SEGMENTS)]
            words = [np.concatenate([np.arange(f.first[s], f.first[s + 1]) for s in seq]) for seq in seqs]
            truth = [np.concatenate([np.full(f.first[s + 1] - f.first[s], label[part[s]]) for s in seq]) for seq in seqs]
            rows, y = np.concatenate(words), np.concatenate(truth)
            size = f.length[rows]
            of = np.repeat(np.arange(len(rows)), size)
            tri = f.trigrams[f.at[rows][of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)]
            scores = np.zeros((len(rows), k))
            for c in range(k):
                scores[:, c] = np.bincount(of, model.trigram[tri, c], len(rows))
            for ids in f.affixes[:, rows]:
                scores += model.affix[ids]
            lex = model.lexicon[f.words[rows]]
            scores += model.lexicon_weight * lex + model.bias
            first = np.concatenate([[0], np.cumsum([len(w) for w in words])])
            post, pairs = _expectations(scores, first, model.step)
            off = -post
            off[np.arange(len(y)), y] += 1
            inner = np.ones(len(y), bool)
            inner[first[:-1]] = False
            seen = np.zeros((k, k))
            np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
            for name, ids, values in (("trigram", tri, off[of]), ("affix", f.affixes[:, rows].ravel(), np.tile(off, (6, 1)))):
                own, ids = np.unique(ids, return_inverse=True)
                g = np.stack([np.bincount(ids, values[:, c], len(own)) for c in range(k)], 1)
                past[name][own] += g * g
                params[name][own] += RATE * g / np.sqrt(past[name][own])
            for name, g in {"lexicon_weight": (off * lex).sum(axis=0), "bias": off.sum(axis=0), "step": seen - pairs}.items():
                past[name] += g * g
                params[name] += RATE * g / np.sqrt(past[name])


def _expectations(scores: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors, and the expected number of each transition, of short sequences."""
    k = scores.shape[1]
    sizes = np.diff(first)
    longest = int(sizes.max())
    valid = np.arange(longest) < sizes[:, None]
    index = np.minimum(first[:-1, None] + np.arange(longest), len(scores) - 1)
    weight = np.where(valid[:, :, None], np.exp(scores - scores.max(axis=1, keepdims=True))[index], 1.0)
    go = np.exp(step)
    forward = np.empty((len(sizes), longest, k))
    backward = np.ones((len(sizes), longest, k))
    state = _scaled(weight[:, 0], 1)
    forward[:, 0] = state
    for t in range(1, longest):
        state = np.where(valid[:, t][:, None], _scaled((state @ go) * weight[:, t], 1), state)
        forward[:, t] = state
    for t in range(longest - 2, -1, -1):
        backward[:, t] = np.where(valid[:, t + 1][:, None], _scaled((weight[:, t + 1] * backward[:, t + 1]) @ go.T, 1), 1.0)
    both = forward * backward
    post = both / both.sum(axis=2, keepdims=True)
    after = (weight * backward)[:, 1:]
    amount = np.maximum(((forward[:, :-1] @ go) * after).sum(axis=2, keepdims=True), 1e-300)
    before = np.where(valid[:, 1:, None], forward[:, :-1] / amount, 0.0)
    return post[valid], go * (before.reshape(-1, k).T @ after.reshape(-1, k))


def train(docs: DataFrame) -> Model | None:
    """A model from the training rows of `docs` (doc_id, text, lang); None if there are none."""
    rows = _training(docs)
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    sizes = dict(sorted((r["lang"], r["n"]) for r in counts))
    names = list(sizes)
    k = len(names)
    size = n_buckets(k)
    model = Model(names, np.zeros((size, k)), np.zeros((size, k)), _lexicon(rows, names), np.ones(k), np.zeros(k), np.zeros((k, k)))
    if k > 1:
        _fit(model, _sample(rows, sizes))
    model.trigram, model.affix = model.trigram.astype(np.float32), model.affix.astype(np.float32)
    return model


LABELS = "doc_id bigint, lang_pred string, score double, runs array<struct<lang: string, first: int, last: int>>"


def label(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, and `runs`: the stretches of words (first to last, from 0) of one language."""
    shared = docs.sparkSession.sparkContext.broadcast(model and vars(model))  # its size depends on the number of languages alone
    run_type = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value) if shared.value else None
        limit = BLOCK_TEXT if m is None else BLOCK_TEXT * LANGUAGES // max(LANGUAGES, len(m.languages))
        for block in blocks(batches, "text", limit):
            langs, scores, runs = [], [], []
            if m is not None:
                f = Features(block.column(1), len(m.trigram))
                post = posteriors(m.scores(f), f.first, m.step)
                best = post.argmax(axis=1)
                weighted = np.concatenate([np.zeros((1, post.shape[1])), np.cumsum(post * f.length[:, None], axis=0)])
                amount = np.concatenate([[0], np.cumsum(f.length)])
            for i in range(block.num_rows):
                text = block.column(1)[i].as_py() or ""
                if m is None or f.first[i] == f.first[i + 1] or not any(map(str.isalpha, text)):
                    langs.append("und")
                    scores.append(0.0)
                    runs.append([])
                    continue
                a, b = f.first[i], f.first[i + 1]
                share = (weighted[b] - weighted[a]) / (amount[b] - amount[a])
                top = int(share.argmax())
                langs.append(m.languages[top])
                scores.append(min(1.0, max(0.0, float(share[top]))))
                own = best[a:b]
                cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
                runs.append([{"lang": m.languages[own[x]], "first": int(x), "last": int(y - 1)} for x, y in zip(cut[:-1], cut[1:])])
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(runs, run_type)],
                                             names=["doc_id", "lang_pred", "score", "runs"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, LABELS)


def language_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, n_runs."""
    docs = docs.select("doc_id", "text", "lang")
    labelled = label(docs, train(docs))
    return labelled.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score",
                           F.size("runs").cast("bigint").alias("n_runs"))
