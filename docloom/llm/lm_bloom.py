"""Language-model scoring with a log-frequency Bloom filter of n-gram counts.

Bigram counts are gathered from all training documents, quantised to powers of two and stored in a
Bloom filter as (bigram, 1), (bigram, 2), ... up to the count's level (Talbot & Osborne 2007). The
filter goes to the workers by broadcast; a bigram's level, 1 + floor(log2(count)), is found by probing
until a level is missing, and the probability is smoothed with the exact unigram probability:

    P(v | u) = (count(u, v) + alpha * P(v)) / (count(u) + alpha)

count(u, v) is the least count of the bigram's level, so that the counts of a context sum to count(u) at
most and its probabilities to 1 at most, but for the filter's false positives (0.8 % of absent bigrams).

The filter has a slice for each bucket of bigrams, sized by what the bucket holds. If all slices
exceed `filter_bytes`, the documents are scored in several passes, each with the slices that fit in
one broadcast, one pass after another: the bound holds at every size and no n-gram is left out.
Unigram counts are exact: blocks of documents ask for the counts of their distinct words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytecode as B
from .common import durable, internal, width

#: Probes of a level.
HASHES = 7
END = B.mix(np.array([0x45AD], np.uint64))[0]
START = B.mix(np.array([0x57A7], np.uint64))[0]
_STEP = B.U(0x9E3779B97F4A7C15)


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit tokens, one END after each document's words, and the documents' offsets in them."""
    low = B.LOWER[buf]
    s, e, first = B.words(low, offs)
    n = len(offs) - 1
    out = np.full(len(s) + n, END, np.uint64)
    doc = np.repeat(np.arange(n), np.diff(first))
    if len(s):
        out[np.arange(len(s)) + doc] = B.span_hash(B.prefix(low), s, e)
    return out, first + np.arange(n + 1)


def contexts(tok: np.ndarray, toff: np.ndarray) -> np.ndarray:
    """The token before each token, START before a document's first."""
    out = np.empty(len(tok), np.uint64)
    out[1:] = tok[:-1]
    out[toff[:-1]] = START
    return out


def pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return B.mix(u * B.U(0xA24BAED4963EE407) + v)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> B.U(48)) % B.U(buckets)).astype(np.int64)


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, n = np.unique(key, return_counts=True)
    return u, n.astype(np.uint32)


def _by_bucket(key: np.ndarray, count: np.ndarray, buckets: int, kind: int, out: list) -> None:
    b = bucket_of(key, buckets)
    order = np.argsort(b, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(b[order])) + 1):
        if len(part):
            # 48 bits of a key and a byte of its count are enough of a row; larger counts follow on their own
            c = count[part]
            big = np.flatnonzero(c > 255)
            out.append((int(b[part[0]]), kind, key[part].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), np.minimum(c, 255).astype(np.uint8).tobytes(), big.astype(np.uint32).tobytes(), c[big].tobytes()))


def _keys48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


_COUNTS = "bucket int, kind int, keys binary, n binary, big binary, more binary"


def _count(buckets: int, piece: int):
    """kind 1: unigrams, kind 2: bigrams, distinct within a piece of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            rows: list = []
            u, n = _counted(np.concatenate([t for t, _ in held]))
            _by_bucket(u, n, buckets, 1, rows)
            u, n = _counted(np.concatenate([pair(contexts(t, o), t) for t, o in held]))
            _by_bucket(u, n, buckets, 2, rows)
            held.clear()
            types = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], ["bucket", "kind", "keys", "n", "big", "more"])

        held: list = []
        size = 0
        for batch in batches:
            buf, offs = B.flat(batch.column(0))
            for i, j in B.pieces(offs):
                held.append(tokens(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]))
                size += offs[j] - offs[i]
                if size >= piece:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for k, n, big, more in zip(*(table[c].to_pylist() for c in ("keys", "n", "big", "more"))):
        c = np.frombuffer(n, np.uint8).astype(np.int64)
        c[np.frombuffer(big, np.uint32)] = np.frombuffer(more, np.uint32)
        keys.append(_keys48(k))
        counts.append(c)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(count[order], first)


def fill_slice(key: np.ndarray, count: np.ndarray) -> tuple[int, bytes]:
    """Bits and bytes of a log-frequency Bloom filter of these counts (1 and more)."""
    level = 1 + np.log2(count).astype(np.int64)
    rep = np.repeat(key, level)
    lev = np.arange(len(rep)) - np.repeat(np.cumsum(level) - level, level)
    bits = max(64, int(np.ceil(len(rep) * HASHES / np.log(2))))
    flags = np.zeros(bits, bool)
    for p in _probes(rep, lev.astype(np.uint64) + B.U(1), np.uint64(bits)):
        flags[p] = True
    return bits, np.packbits(flags, bitorder="little").tobytes()


def _probes(key: np.ndarray, level: np.ndarray, bits) -> Iterator[np.ndarray]:
    x = B.mix(key + level * _STEP)
    y = (x >> B.U(32)) | B.U(1)
    for i in range(HASHES):
        yield ((x + B.U(i) * y) % bits).astype(np.int64)


class Filter:
    """Slices of a range of buckets, as they are broadcast."""

    def __init__(self, slices: list[tuple[int, int, bytes]], buckets: int):
        self.bits, self.missing = np.zeros(buckets, np.uint64), None
        self.base = np.zeros(buckets, np.int64)
        at = 0
        for b, bits, raw in slices:
            self.bits[b], self.base[b] = bits, at
            at += len(raw)
        self.data = np.frombuffer(b"".join(raw for _, _, raw in slices), np.uint8)

    def counts(self, key: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Estimated counts: the least count of the level, 0 if no level is found."""
        level = np.zeros(len(key), np.int64)
        live = np.flatnonzero(self.bits[bucket] > 0)
        key = key & B.U((1 << 48) - 1)
        step = 1
        while len(live):
            bits, base = self.bits[bucket[live]], self.base[bucket[live]]
            x = B.mix(key[live] + B.U(step * int(_STEP) & (1 << 64) - 1))
            y = (x >> B.U(32)) | B.U(1)
            for i in range(HASHES):
                p = ((x + B.U(i) * y) % bits).astype(np.int64)
                hit = (self.data[base + (p >> 3)] >> (p & 7).astype(np.uint8)) & 1 > 0
                live, x, y, bits, base = live[hit], x[hit], y[hit], bits[hit], base[hit]
            level[live] = step
            step += 1
        return np.where(level > 0, np.exp2(level - 1), 0.0)


def _learn(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        bucket = table["bucket"][0].as_py()
        key, count = _summed(table)
        if kind == 1:
            row = (1, bucket, int(count.sum()), len(key), b"")
        else:
            bits, raw = fill_slice(key, count)
            row = (2, bucket, bits, len(key), raw)
        return pa.table({"kind": pa.array([row[0]], pa.int32()), "bucket": pa.array([row[1]], pa.int32()), "x": [row[2]], "y": [row[3]], "raw": pa.array([row[4]], pa.binary())})

    return run


def _ask(text_col: str, train_col: str, block_col: str, buckets: int):
    """A block's distinct tokens with their counts in its training documents (0 included)."""

    def run(table: pa.Table) -> pa.Table:
        u, n = _block_counts(table, text_col, train_col)
        b = bucket_of(u, buckets)
        order = np.argsort(b, kind="stable")
        rows = []
        for part in np.split(order, np.flatnonzero(np.diff(b[order])) + 1):
            rows.append((int(b[part[0]]), table[block_col][0].as_py(), u[part].tobytes(), n[part].astype(np.uint32).tobytes()))
        return pa.table({n: pa.array(list(c), t) for (n, t), c in zip((("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())), zip(*rows))})

    return run


def _block_counts(table: pa.Table, text_col: str, train_col: str) -> tuple[np.ndarray, np.ndarray]:
    buf, offs = B.flat(table[text_col])
    train = table[train_col].to_numpy(zero_copy_only=False)
    seen, used = [np.array([START], np.uint64)], [np.array([int(train.sum())])]
    for i, j in B.pieces(offs):
        tok, toff = tokens(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        u, inv = np.unique(tok, return_inverse=True)
        seen.append(u)
        used.append(np.bincount(inv, np.repeat(train[i:j], np.diff(toff)), len(u)).astype(np.int64))
    key, count = np.concatenate(seen), np.concatenate(used)
    u, inv = np.unique(key, return_inverse=True)
    return u, np.bincount(inv, count, len(u)).astype(np.int64)


def _reply(table: pa.Table) -> pa.Table:
    keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    n = np.frombuffer(b"".join(table["n"].to_pylist()), np.uint32)
    u, inv = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inv, n, len(u)).astype(np.int64)[inv]
    parts = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({"block": table["block"], "keys": table["keys"], "total": pa.array([p.tobytes() for p in parts], pa.binary())})


def order_hash(tok: np.ndarray, toff: np.ndarray) -> np.ndarray:
    """64-bit hashes of the documents' sequences of tokens."""
    at = np.arange(len(tok)) - np.repeat(toff[:-1], np.diff(toff))
    return np.add.reduceat(B.mix(tok + at.astype(np.uint64) * _STEP), toff[:-1]).view(np.int64)


def _score(text_col, train_col, buckets, shared, n_tokens: int, n_types: int, alpha: float, keep: list[str], first: bool, hash_col: str | None):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table({})
        key = np.frombuffer(b"".join(replies["keys"].to_pylist()), np.uint64)
        total = np.frombuffer(b"".join(replies["total"].to_pylist()), np.int64)
        order = np.argsort(key)
        key, total = key[order], total[order]
        filt: Filter = shared.value
        buf, offs = B.flat(docs[text_col])
        out = {n: [] for n in ("n_tokens", "n_known", "base_score", "score", *([hash_col] if hash_col else []))}
        for i, j in B.pieces(offs):
            tok, toff = tokens(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            before = contexts(tok, toff)
            c = total[np.searchsorted(key, tok)]
            cu = total[np.searchsorted(key, before)]
            big = pair(before, tok)
            at = bucket_of(big, buckets)
            p1 = (c + 0.1) / (n_tokens + 0.1 * (n_types + 1))
            mine = filt.bits[at] > 0
            c2 = np.minimum(filt.counts(big, at), cu)
            logp = np.log10((c2 + alpha * p1) / (cu + alpha))
            if not first:
                logp[~mine] = 0
            elif filt.missing is not None:
                logp[filt.missing[at]] = 0
            s = toff[:-1]
            out["n_tokens"].append(np.diff(toff))
            out["n_known"].append(np.add.reduceat((c > 0).astype(np.int64), s))
            out["base_score"].append(np.add.reduceat(np.log10(p1), s))
            out["score"].append(np.add.reduceat(logp, s))
            if hash_col:
                out[hash_col].append(order_hash(tok, toff))
        return pa.table({**{k: docs[k] for k in keep}, **{k: np.concatenate(v) for k, v in out.items()}})

    return run


def score(docs: DataFrame, train: str, keep: tuple[str, ...] = ("doc_id",), alpha: float = 64.0, filter_bytes: int = 96 << 20, block_bytes: int = 4 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Log10 probabilities of every whole text of docs under a model of the rows where `train` holds.

    train is an SQL condition; where it is null, a row is neither learned from nor held out. A-Z is lower-cased; a text's tokens
    are its words [^\\x20\\x09-\\x0D]+ and one end. Null and empty texts are one end. Returns the columns `keep` of docs,
    held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score (add-0.1 unigrams) and
    score (the smoothed bigram model). Without training tokens every score is that of the empty counts.
    """
    spark = docs.sparkSession
    n = width(spark)
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(-(-size // bucket_bytes), 2 * n)
    keep = tuple(c for c in docs.columns if c in keep)
    known = F.coalesce(F.expr(train), F.lit(False))
    learned = docs.where(known).select(F.col("text").cast("string").alias("text"))
    counts = learned.mapInArrow(_count(buckets, block_bytes), _COUNTS)
    model = durable(counts.groupBy("kind", "bucket").applyInArrow(_learn(buckets), "kind int, bucket int, x long, y long, raw binary"))
    n_tokens, n_types = model.where("kind = 1").agg(F.coalesce(F.sum("x"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
    sizes = sorted((r.bucket, r.size) for r in model.where("kind = 2").select("bucket", F.octet_length("raw").alias("size")).collect())
    passes: list[list[int]] = [[]]
    held = 0
    for b, size in sizes:
        if held + size > filter_bytes and passes[-1]:
            passes.append([])
            held = 0
        passes[-1].append(b)
        held += size

    d = docs.select(*dict.fromkeys((*keep, "doc_id", "text")))
    block_col, train_col, text_col, held_col = (internal(d, x) for x in ("_block", "_train", "_text", "_held"))
    blocks = max(-(-size // block_bytes), 2 * n)
    d = docs.select(*keep, F.col("text").cast("string").alias(text_col), known.alias(train_col), F.coalesce(~F.expr(train), F.lit(False)).alias(held_col), F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias(block_col)).repartition(block_col)
    asked = d.groupBy(block_col).applyInArrow(_ask(text_col, train_col, block_col, buckets), "bucket int, block long, keys binary, n binary")
    replies = asked.groupBy("bucket").applyInArrow(_reply, "block long, keys binary, total binary")
    kinds = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    row = internal(d, "_row")
    made = ("n_tokens", "n_known", "base_score", "score")
    hash_col = internal(d, "_order") if len(passes) > 1 else None
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in (*keep, held_col)), "n_tokens long, n_known long, base_score double, score double", *([f"`{hash_col}` long"] if hash_col else [])])
    out = None
    every = {b for b, _ in sizes}
    for k, part in enumerate(passes):
        slices = [(r.bucket, r.x, bytes(r.raw)) for r in model.where((F.col("kind") == 2) & F.col("bucket").isin(part)).sort("bucket").collect()] if part else []
        filt = Filter(slices, buckets)
        filt.missing = np.isin(np.arange(buckets), sorted(every - set(part))) if len(passes) > 1 else None
        shared = spark.sparkContext.broadcast(filt)
        del slices, filt
        one = d.groupBy(block_col).cogroup(replies.groupBy("block")).applyInArrow(_score(text_col, train_col, buckets, shared, int(n_tokens), int(n_types), alpha, [*keep, held_col], k == 0, hash_col), schema)
        if len(passes) > 1:  # the next pass has its own filter
            one = durable(one)
            shared.destroy()
        out = one if out is None else out.unionByName(one)
    if len(passes) > 1:
        # rows that agree in all that is kept and in the sequence of tokens are alike in score too: their parts add up to so many times it
        by = [*keep, held_col, *made[:2], hash_col]
        out = out.groupBy(*by).agg(F.min("base_score").alias("base_score"), F.sum("score").alias("score"), F.count("*").alias(row)).withColumn(row, (F.col(row) / len(passes)).cast("int"))
        out = out.withColumn("score", F.col("score") / F.col(row)).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(row)))).drop("_copy", row)
    return out.select(*(c for c in keep if c not in (*made, "held_out", "train_tokens")), F.col(held_col).alias("held_out"), *made[:2], F.lit(int(n_tokens)).cast("long").alias("train_tokens"), *made[2:])
