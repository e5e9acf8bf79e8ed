"""Document quality by supervised subword embeddings.

A document is the sum of the averages of the learned vectors of its hashed words and of its hashed
character n-grams of each order; a linear softmax layer over it gives the class probabilities. One group
more is no subword: two learned vectors say of each word whether it repeats the one before it. Averages
of words and n-grams can't tell a text of words said over and over (see README for figures).
Vectors and layer are trained together by stochastic gradient descent in numpy, in one task, over at
most `sample_rows` labelled documents of `sample_bytes` bytes together.
Scoring is distributed: since averaging and the layer are both linear, each bucket's vector is reduced
to its contribution to the logit, a table of fixed size that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytecode as B
from .common import Bags, fitted, internal, sampled, within

BITS, GRAMS = 16, (2, 3, 4)
_SIZE = 1 << BITS


def features(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words, repetitions and each order of character n-grams: bucket numbers by position and the documents' offsets in them."""
    if not len(buf):
        return
    p = B.prefix(buf)
    s, e, first = B.words(buf, offs)
    word = B.span_hash(p, s, e)
    yield (word >> B.U(64 - BITS)).astype(np.int32), first
    again = np.full(len(word), _SIZE, np.int32)
    again[1:] += word[1:] == word[:-1]
    again[first[:-1][first[:-1] < len(again)]] = _SIZE
    yield again, first
    char = np.flatnonzero((buf & 0xC0) != 0x80)  # where characters start
    ends = np.append(char, len(buf))
    stop = np.repeat(offs[1:], np.diff(offs))[char]
    for k, n in enumerate(GRAMS, 2):
        s, e = char[: max(0, len(char) - n + 1)], ends[n:]
        ok = e <= stop[: len(s)]
        s, e = s[ok], e[ok]
        yield (B.span_hash(p, s, e) >> B.U(64 - BITS)).astype(np.int32) + k * _SIZE, np.searchsorted(s, offs)


def _bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct buckets with their shares of their groups."""
    buf, offs = B.flat(pa.array([text or ""], pa.large_string()))
    groups = [np.unique(i, return_counts=True) for i, _ in features(buf, offs) if len(i)] or [(np.empty(0, np.int32), np.empty(0))]
    return np.concatenate([u for u, _ in groups]), np.concatenate([n / max(1, n.sum()) for _, n in groups]).astype(np.float32)


def train(texts: Iterable[str | None], labels: list[int], dim: int = 12, epochs: int = 8, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Bucket contributions to the logit of label 1, and its bias.

    Plain SGD with each coordinate's rate divided by the root of its squared gradients so far.
    With one class only, or no rows, the contributions are 0 and the bias follows the labels.
    """
    held = Bags(ids="i", share="f")
    for t in texts:
        ids, share = _bag(t)
        held.add(ids=ids, share=share)
    bags = list(zip(held.views("ids"), held.views("share")))
    y = np.array(labels, np.int64)
    n_features = _SIZE * (2 + len(GRAMS))
    if not len(y) or y.min() == y.max():
        return np.zeros(n_features, np.float32), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    rng = np.random.Generator(np.random.PCG64(seed))
    emb = rng.normal(0, 0.3, (n_features, dim)).astype(np.float32)
    out = rng.normal(0, 0.3, (dim, 2)).astype(np.float32)
    bias = np.log(np.bincount(y, minlength=2) / len(y)).astype(np.float32)
    g_emb, g_out = np.full(n_features, 1e-8, np.float32), np.full((dim, 2), 1e-4, np.float32)
    for epoch in range(epochs):
        for i in rng.permutation(len(y)):
            ids, share = bags[i]
            if not len(ids):
                continue
            e = share @ emb[ids]
            z = e @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            down = out @ p
            step = np.outer(e, p)
            g_out += step * step
            out -= rate * step / np.sqrt(g_out)
            g_emb[ids] += share * share * (down @ down)
            emb[ids] -= (rate * share / np.sqrt(g_emb[ids]))[:, None] * down
            bias -= 0.01 * p
    delta = out[:, 1] - out[:, 0]
    return (emb @ delta).astype(np.float32), float(bias[1] - bias[0])


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = model.value
        for batch in batches:
            buf, offs = B.flat(batch.column(0))
            z = np.full(len(batch), bias)
            for i, j in B.pieces(offs):
                for ids, at in features(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]):
                    c = np.concatenate(([0.0], np.cumsum(weight[ids], dtype=np.float64)))
                    z[i:j] += (c[at[1:]] - c[at[:-1]]) / np.maximum(np.diff(at), 1)
            score = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            yield pa.RecordBatch.from_arrays([pa.array(score), *batch.columns[1:]], ["_score", *batch.schema.names[1:]])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", train_on: str = "crc32(cast(doc_id as string)) % 5 <> 0", sample_rows: int = 4000, sample_bytes: int = 32 << 20) -> tuple[np.ndarray, float]:
    """A model from labelled rows where train_on holds, whole texts; rows whose label is null teach nothing.

    Of those rows the sample_rows of least hash are taken, in that order, and of these all but such as
    would bring the texts to more than sample_bytes. Labels that name one doc_id twice count as two.
    """
    ids = labels.where(f"({train_on}) and {label} is not null").select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"), F.xxhash64("doc_id").alias("_h"))
    ids = ids.orderBy("_h", "_id", "_y").limit(sample_rows).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, float]:
        y: list[int] = []

        def texts() -> Iterator[str | None]:
            for row in within(batches, sample_bytes):
                y.append(row["_y"])
                yield row["text"]

        return train(texts(), y)

    return fitted(sampled(docs, ids), ["_h", "_id", "_y"], run)


def score(docs: DataFrame, model: tuple[np.ndarray, float], name: str = "score") -> DataFrame:
    """docs with the probability of label 1 of every whole text in column `name`.

    Null, empty and too short texts have the model's bias alone. An existing column of that name is
    replaced; all other columns are kept. No other column than text is looked at.
    """
    others = [c for c in docs.columns if c.lower() != name.lower()]
    tmp = internal(docs, "_text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(["_score double", *(f"`{c}` {kinds[c]}" for c in others)])
    out = docs.select(F.col("text").cast("string").alias(tmp), *others).mapInArrow(_scorer(shared), schema.replace("_score", internal(docs, "_score"), 1))
    return out.select(*others, F.col(out.columns[0]).alias(name))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    The model learns `quality` from labelled documents whose crc32(doc_id as text) mod 5 is not 0.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, **options))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """docs without the rows whose score is below the threshold; all columns as they were."""
    name = internal(docs, "_quality")
    return score(docs, fit(docs, labels, **options), name).where(F.col(name) >= threshold).select(*docs.columns)
