"""Toxicity categories by classifier chains.

The categories are predicted one after another. Each is a linear (logistic) model over the presence
of hashed words and stems and the log-odds of the categories before it. For training, those earlier
probabilities are out-of-fold predictions, so that a later model sees them as noisy as they will be
on new documents. Models are trained in numpy by SGD, in one task, on at most `sample_rows` labelled
documents and have a fixed size; scoring is distributed over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytecode as B
from .common import Bags, fitted, sampled, within

BITS = 18
#: Besides whole words, their first so many bytes, since inflected words share a stem.
STEMS = (3, 4, 5, 6)
#: Words are runs of ASCII letters and non-ASCII bytes: punctuation does not hide a word.
_GAPS = np.ones(256, bool)
_GAPS[65:91] = _GAPS[97:123] = False
_GAPS[128:] = False


def bags(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each document's words and stems, and the documents' offsets in them."""
    low = B.LOWER[buf]
    s, e, first = B.words(low, offs, _GAPS)
    n = len(offs) - 1
    if not len(s):
        return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
    p, doc = B.prefix(low), np.repeat(np.arange(n), np.diff(first)) << BITS
    keys = []
    for k in (*STEMS, 0):
        long = np.flatnonzero(e - s > k) if k else slice(None)
        word = (B.span_hash(p, s[long], s[long] + k if k else e)) >> B.U(64 - BITS)
        keys.append(np.unique(doc[long] | word.astype(np.int64)))
    key = np.unique(np.concatenate(keys))
    return key & (1 << BITS) - 1, np.searchsorted(key >> BITS, np.arange(n + 1))


def telling(x: list[np.ndarray], y: np.ndarray, least: int = 4, z: float = 5.0) -> np.ndarray:
    """Buckets of at least so many documents whose share of the category is z standard errors off."""
    ids = np.concatenate([*x, np.empty(0, np.int32)])
    n = np.bincount(ids, minlength=1 << BITS)
    t = np.bincount(ids, np.repeat(y, [len(i) for i in x]), 1 << BITS)
    p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    return (n >= least) & (np.abs(t - n * p) >= z * np.sqrt(np.maximum(n, 1) * p * (1 - p)))


def _logistic(x: list[np.ndarray], extra: np.ndarray, y: np.ndarray, epochs: int = 12, rate: float = 0.5, decay: float = 1e-3, seed: int = 3) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the presence of telling() words, of the extra inputs, and the bias, by SGD with adaptive rates."""
    use = telling(x, y)
    x = [i[use[i]] for i in x]
    rng = np.random.Generator(np.random.PCG64(seed))
    w, g = np.zeros(1 << BITS, np.float32), np.full(1 << BITS, 1.0, np.float32)
    v, gv = np.zeros(extra.shape[1]), np.ones(extra.shape[1])
    base = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    b, gb = float(np.log(base / (1 - base))), 1.0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            ids = x[i]
            z = w[ids].sum() + extra[i] @ v + b
            d = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[i]
            if abs(d) < 1e-4:
                continue
            g[ids] += d * d
            w[ids] -= rate * (d + decay * w[ids]) / np.sqrt(g[ids])
            gv += (d * extra[i]) ** 2
            v -= 0.1 * d * extra[i] / np.sqrt(gv)
            gb += d * d
            b -= 0.1 * d / np.sqrt(gb)
    return w, v, b


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


class Chain:
    """Models of the categories in order."""

    def __init__(self, names: list[str]):
        self.names = names
        self.models: list[tuple[np.ndarray, np.ndarray, float]] = []

    def fit(self, texts: Iterable[str | None], y: np.ndarray, folds: int = 5) -> Chain:
        """y: 0/1, a row for each text and a column for each category; or what makes it once the texts are read."""
        # text by text: the hashing of all texts at once would take a hundred times their size
        held = Bags(ids="i")
        for t in texts:
            held.add(ids=bags(*B.flat(pa.array([t or ""], pa.large_string())))[0])
        x = held.views("ids")
        y = y() if callable(y) else y
        fold = np.arange(len(x)) % folds
        earlier = np.zeros((len(x), 0))
        for k in range(len(self.names)):
            out = np.zeros(len(x))
            for f in range(folds):
                tr = np.flatnonzero(fold != f)
                w, v, b = _logistic([x[i] for i in tr], earlier[tr], y[tr, k])
                for i in np.flatnonzero(fold == f):
                    out[i] = 1 / (1 + np.exp(-np.clip(w[x[i]].sum() + earlier[i] @ v + b, -40, 40)))
            self.models.append(_logistic(x, earlier, y[:, k]))
            earlier = np.column_stack((earlier, _odds(out)))
        return self

    def predict(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probabilities (documents, categories)."""
        out, earlier = [], np.zeros((len(at) - 1, 0))
        for w, v, b in self.models:
            c = np.concatenate(([0.0], np.cumsum(w[ids], dtype=np.float64)))
            z = c[at[1:]] - c[at[:-1]] + earlier @ v + b
            out.append(1 / (1 + np.exp(-np.clip(z, -40, 40))))
            earlier = np.column_stack((earlier, _odds(out[-1])))
        return np.column_stack(out)


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: Chain = model.value
        for batch in batches:
            buf, offs = B.flat(batch.column(1))
            out = [np.zeros((0, len(chain.names)))]
            for i, j in B.pieces(offs):
                out.append(chain.predict(*bags(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])))
            p = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, k]) for k in range(p.shape[1]))], ["doc_id", *(f"p_{n}" for n in chain.names)])

    return run


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str], train_on: str = "crc32(cast(doc_id as string)) % 5 <> 0", sample_rows: int = 4000, sample_bytes: int = 32 << 20) -> Chain:
    """A chain over `categories` (name: SQL condition over labels, in chain order); a condition that is null counts as false.

    Of the labelled rows where train_on holds the sample_rows of least hash are taken, in that order, and
    of these all but such as would bring the texts to more than sample_bytes.
    """
    cols = [F.coalesce(F.expr(e), F.lit(False)).cast("int").alias(f"_y{k}") for k, e in enumerate(categories.values())]
    by = [f"_y{k}" for k in range(len(cols))]
    ids = labels.where(train_on).select(F.col("doc_id").alias("_id"), *cols, F.xxhash64("doc_id").alias("_h")).orderBy("_h", "_id", *by).limit(sample_rows).distinct()
    names = list(categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Chain:
        y: list[list[int]] = []

        def texts() -> Iterator[str | None]:
            for row in within(batches, sample_bytes):
                y.append([row[c] for c in by])
                yield row["text"]

        return Chain(names).fit(texts(), lambda: np.array(y, np.float64).reshape(len(y), len(by)))

    return fitted(sampled(docs, ids), ["_h", "_id", *by], run)


def classify(docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, threshold: float = 0.3, **options) -> DataFrame:
    """(doc_id, held_out, p_<category> ..., score, toxic) for every row of docs, over whole texts.

    By default the chain is low_quality, then toxic. score is the last category's probability, toxic
    is 1 if it reaches the threshold. Null, empty and wordless texts have the chain's bias alone.
    Columns other than doc_id and text are not read.
    """
    categories = categories or {"low_quality": "quality = 0", "toxic": "toxic = 1"}
    chain = fit(docs, labels, categories, **options)
    names = [f"p_{n}" for n in chain.names]
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_scorer(shared), f"doc_id {kind}, " + ", ".join(f"`{n}` double" for n in names))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), *names, F.col(names[-1]).alias("score"), (F.col(names[-1]) >= threshold).cast("int").alias("toxic"))
