"""Language of documents by a linear-chain conditional random field over their words.

Every word is labelled with a language from its affixes, its character n-grams and a lexicon of training
words, and from learned transitions between the labels of neighbours, by forward-backward. A
document's language is the one with the largest sum of word posteriors; its score is that share.
The field is trained in numpy on bounded samples of each language, whose documents are cut into
stretches and interleaved, so that it sees code-switched text with known labels.

Forward-backward runs over all words of many documents at once: the sequence is laid out in rows,
the rows' transfer matrices are multiplied column by column for all rows together, and a document's
first word has a transfer matrix that forgets its past.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytecode as B
from .common import fitted, sampled, within

BITS = 17
_SIZE = 1 << BITS
_GAPS = np.ones(256, bool)
_GAPS[65:91] = _GAPS[97:123] = False
_GAPS[128:] = False
AFFIXES, GRAMS = (1, 2, 3, 4), (2, 3)


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    return (B.mix(h + B.U(salt)) >> B.U(64 - BITS)).astype(np.int64)


def characters(buf: np.ndarray) -> np.ndarray:
    """Where the characters of the UTF-8 buffer start, and its end."""
    return np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))


def word_features(p: np.ndarray, char: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of the words [s, e) of the buffer behind prefix() p and characters() char, and the words' offsets in them."""
    ids, owner = [], []
    at = np.arange(len(s))
    cs, ce = np.searchsorted(char, s), np.searchsorted(char, e)
    for k in AFFIXES:
        long = np.flatnonzero(ce - cs >= k)
        ids += [_bucket(B.span_hash(p, s[long], char[cs[long] + k]), 11), _bucket(B.span_hash(p, char[ce[long] - k], e[long]), 12)]
        owner += [long, long]
    ids.append(_bucket(B.span_hash(p, s, e), 13))  # the lexicon
    owner.append(at)
    for k in GRAMS:
        n = np.maximum(ce - cs - k + 1, 0)
        w = np.repeat(at, n)
        start = np.repeat(cs, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids.append(_bucket(B.span_hash(p, char[start], char[start + k]), 14))
        owner.append(w)
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.searchsorted(owner[order], np.arange(len(s) + 1))


class Field:
    """Label names, feature weights (buckets, labels), log transitions (labels, labels)."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        k = len(labels)
        self.weight = np.zeros((_SIZE, k), np.float32)
        self.move = np.zeros((k, k))

    def emissions(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log potentials of each word, by the mean weight of its features times the root of their number."""
        n = np.diff(at)
        w = np.add.reduceat(self.weight[ids], at[:-1], axis=0) if len(n) else np.zeros((0, len(self.labels)), np.float32)
        return w / np.sqrt(np.maximum(n, 1))[:, None]

    def marginals(self, emit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors of each word's label, and expected transitions; first marks words that start a sequence."""
        n, k = emit.shape
        move = np.exp(self.move)
        rows = max(1, int(np.sqrt(n)))
        cols = -(-n // rows)
        pad = rows * cols - n
        e = np.exp(emit - emit.max(1, keepdims=True)).astype(np.float64)
        e = np.concatenate((e, np.ones((pad, k)))).reshape(rows, cols, k)
        kind = np.concatenate((first.astype(np.int8), np.full(pad, 2, np.int8)))
        if n:
            kind[0] = 1
        kind = kind.reshape(rows, cols)
        bank = np.stack((move, np.ones((k, k)) / k, np.eye(k)))
        whole = np.broadcast_to(np.eye(k), (rows, k, k))
        for c in range(cols):
            whole = whole @ (bank[kind[:, c]] * e[:, c, None, :])
            whole /= whole.max((1, 2), keepdims=True)
        left, right = np.empty((rows, k)), np.empty((rows, k))
        v = np.ones(k) / k
        for r in range(rows):
            left[r] = v
            v = v @ whole[r]
            v /= v.sum()
        v = np.ones(k)
        for r in range(rows - 1, -1, -1):
            right[r] = v
            v = whole[r] @ v
            v /= v.sum()
        alpha = np.empty((cols, rows, k))
        v = left
        for c in range(cols):
            v = np.einsum("ri,rij->rj", v, bank[kind[:, c]]) * e[:, c]
            v /= v.sum(1, keepdims=True)
            alpha[c] = v
        post = np.empty((cols, rows, k))
        pairs = np.zeros((k, k))
        v = right
        for c in range(cols - 1, -1, -1):
            p = alpha[c] * v
            post[c] = p / p.sum(1, keepdims=True)
            u = e[:, c] * v
            inner = kind[:, c] == 0
            if inner.any():
                a = (alpha[c - 1] if c else left)[inner]
                x = a[:, :, None] * move * u[inner][:, None, :]
                pairs += (x / x.sum((1, 2), keepdims=True)).sum(0)
            v = np.einsum("rij,rj->ri", bank[kind[:, c]], u)
            v /= v.sum(1, keepdims=True)
        return post.transpose(1, 0, 2).reshape(rows * cols, k)[:n], pairs


def train(texts: list[str], labels: list[str], epochs: int = 3, rate: float = 0.3, seed: int = 5) -> Field:
    """A field from texts of one language each; without texts it has no labels."""
    names = sorted(set(labels))
    field = Field(names)
    if not names:
        return field
    rng = np.random.Generator(np.random.PCG64(seed))
    buf, offs = B.flat(pa.array([t or "" for t in texts], pa.large_string()))
    low = B.LOWER[buf]
    s, e, first = B.words(low, offs, _GAPS)
    p, char = B.prefix(low), characters(low)
    y = np.repeat(np.array([names.index(x) for x in labels]), np.diff(first))
    # stretches of 5 to 60 words of one document, in random order; 1 to 12 of them make a sequence
    cuts, docs = [], np.repeat(np.arange(len(texts)), np.diff(first))
    at = 0
    while at < len(s):
        to = min(at + int(rng.integers(5, 61)), int(first[docs[at] + 1]))
        cuts.append((at, to))
        at = to
    square, moved = np.full((_SIZE, len(names)), 1.0, np.float32), np.ones((len(names), len(names)))
    for epoch in range(epochs):
        order = rng.permutation(len(cuts))
        for batch in range(0, len(order), 120):
            part = [np.arange(*cuts[i]) for i in order[batch : batch + 120]]
            w = np.concatenate(part)
            start = np.zeros(len(w), bool)
            ends = np.cumsum([0, *(len(x) for x in part)])[:-1]
            start[ends[np.cumsum(rng.integers(1, 13, len(ends))) % len(ends)]] = start[0] = True
            ids, off = word_features(p, char, s[w], e[w])
            post, pairs = field.marginals(field.emissions(ids, off), start)
            gold = np.zeros_like(post)
            gold[np.arange(len(w)), y[w]] = 1
            g = ((post - gold) / np.sqrt(np.maximum(np.diff(off), 1))[:, None]).astype(np.float32)
            g = np.repeat(g, np.diff(off), axis=0)
            u, inv = np.unique(ids, return_inverse=True)
            total = np.stack([np.bincount(inv, g[:, k], len(u)) for k in range(len(names))], 1).astype(np.float32)
            square[u] += total * total
            field.weight[u] -= rate * (total / np.sqrt(square[u]) + 1e-4 * field.weight[u])
            seen = np.zeros_like(pairs)
            inner = np.flatnonzero(~start)
            np.add.at(seen, (y[w][inner - 1], y[w][inner]), 1)
            d = pairs - seen
            moved += d * d
            field.move -= rate * d / np.sqrt(moved)
    return field


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field: Field = model.value
        names = np.array([*field.labels, "und"], object)
        for batch in batches:
            buf, offs = B.flat(batch.column(1))
            langs, scores = [], []
            for i, j in B.pieces(offs):
                best, share = identify(field, buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                langs.append(best)
                scores.append(share)
            best = np.concatenate([*langs, np.empty(0, np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(np.concatenate([*scores, np.empty(0)]))], ["doc_id", "lang_pred", "score"])

    return run


def identify(field: Field, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each document's label (the labels' number for und) and its share of the posteriors."""
    n, k = len(offs) - 1, len(field.labels)
    best, share = np.full(n, k), np.zeros(n)
    low = B.LOWER[buf]
    s, e, first = B.words(low, offs, _GAPS)
    if not k or not len(s):
        return best, share
    p = B.prefix(low)
    h = B.span_hash(p, s, e)
    _, at, inv = np.unique(h, return_index=True, return_inverse=True)
    ids, off = word_features(p, characters(low), s[at], e[at])
    emit = field.emissions(ids, off)[inv]
    start = np.zeros(len(s), bool)
    full = np.flatnonzero(np.diff(first))
    start[first[:-1][full]] = True
    post, _ = field.marginals(emit, start)
    total = np.add.reduceat(post, first[:-1][full], axis=0)
    total /= total.sum(1, keepdims=True)
    best[full], share[full] = total.argmax(1), total.max(1)
    ascii_letters = np.concatenate(([0], np.cumsum((low >= 97) & (low <= 122))))[offs]
    for d in full[np.diff(ascii_letters)[full] == 0]:  # non-ASCII only: is any of it a letter?
        if not any(c.isalpha() for c in buf[offs[d] : offs[d + 1]].tobytes().decode("utf-8", "ignore")):
            best[d], share[d] = k, 0.0
    return best, share


def fit(docs: DataFrame, train_on: str = "crc32(cast(doc_id as string)) % 5 <> 0", rows_per_language: int = 400, sample_bytes: int = 16 << 20) -> Field:
    """A field from whole texts of each non-null lang where train_on holds; null texts teach nothing.

    Of each language the rows_per_language rows of least hash are taken, and of all these, in that order,
    all but such as would bring the texts to more than sample_bytes. One scan ranks all languages: each
    task passes on no more than it needs of each.
    """
    rows = docs.select("doc_id", "lang", "text").where(f"({train_on}) and lang is not null and text is not null")
    keyed = rows.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.xxhash64("doc_id").alias("_h"))
    ranked = keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_id")))
    ids = ranked.where(F.col("_rank") <= rows_per_language).select("_id", "_lang", "_h").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Field:
        got = list(within(batches, sample_bytes))
        return train([r["text"] for r in got], [r["_lang"] for r in got])

    found = sampled(rows.withColumn("doc_id", F.struct("doc_id", "lang")), ids.withColumn("_id", F.struct(F.col("_id").alias("doc_id"), F.col("_lang").alias("lang"))))
    return fitted(found.withColumn("_id", F.col("_id.doc_id")), ["_h", "_id", "_lang"], run)


def classify(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of docs (doc_id, text, lang), over whole texts.

    It learns from documents whose crc32(doc_id as text) mod 5 is not 0. lang_pred is a learned
    language; `und`, with score 0, if the text is null or has no letter, or nothing was learned.
    """
    field = fit(docs, **options)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_predict(shared), f"doc_id {kind}, lang_pred string, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
