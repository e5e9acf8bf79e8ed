"""Exact top-k search with a bit-sliced index.

Vectors are quantised to integers; for a block of rows each bit of each component is a bitmap over
the rows. A query's scores are the sum of those bitmaps, each as often as the query component's bits
say: carry-save adders work on whole bitmaps, so no row's score is computed on its own. The k best rows
are then selected from the most significant slice of the sum downward; rows that are still equal
at the last slice are resolved by vec_id. Blocks have a bounded number of rows, query groups a
bounded number of queries; a block and a group meet in one task, and the blocks' best are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

_ALL = ~np.uint64(0)


def slices(x: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps (components, bits, words) of the non-negative integers x (rows, components)."""
    n = -(-len(x) // 64) * 64
    out = np.empty((x.shape[1], bits, n // 64), np.uint64)
    for d in range(x.shape[1]):
        col = np.zeros(n, np.int64)
        col[: len(x)] = x[:, d]
        for b in range(bits):
            out[d, b] = np.packbits(((col >> b) & 1).astype(bool), bitorder="little").view(np.uint64)
    return out


def weighted_sum(maps: np.ndarray, inverse: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices, least first, of sum(query * x) + offset over the rows, and the offset.

    maps holds x + 2**(bits-1). A negative component adds its absolute value times the inverted bits.
    """
    bits = maps.shape[1]
    half, top = 1 << (bits - 1), (1 << bits) - 1
    queue: list[list[np.ndarray]] = [[] for _ in range(bits)]
    offset = 0
    for d in np.flatnonzero(query):
        q = int(query[d])
        src = maps[d] if q > 0 else inverse[d]
        offset += q * half if q > 0 else -q * (top - half)
        w, e = abs(q), 0
        while w:
            if w & 1:
                while len(queue) < e + bits:
                    queue.append([])
                for b in range(bits):
                    queue[e + b].append(src[b])
            w >>= 1
            e += 1
    out = []
    k = 0
    while k < len(queue):
        todo = queue[k]
        if len(todo) > 1 and k + 1 == len(queue):
            queue.append([])
        while len(todo) >= 3:
            a, b, c = todo.pop(), todo.pop(), todo.pop()
            x = a ^ b
            s = x ^ c
            np.bitwise_and(x, c, out=x)
            x |= a & b
            queue[k + 1].append(x)
            # the sum goes to the front, so that the depth of the tree stays low
            todo.insert(0, s)
        if len(todo) == 2:
            a, b = todo
            queue[k + 1].append(a & b)
            todo = [a ^ b]
        out.append(todo[0] if todo else np.zeros(maps.shape[2], np.uint64))
        k += 1
    return out, offset


def select(total: list[np.ndarray], live: np.ndarray, k: int) -> np.ndarray:
    """Bitmap of the k live rows with the largest sums; of rows equal to the last, the first ones."""
    sure, equal = np.zeros_like(live), live
    if int(np.bitwise_count(live).sum()) <= k:
        return live
    for s in reversed(total):
        x = sure | (equal & s)
        n = int(np.bitwise_count(x).sum())
        if n == k:
            return x
        if n > k:
            equal = equal & s
        else:
            sure, equal = x, equal & ~s
    rest = np.flatnonzero(np.unpackbits(equal.view(np.uint8), bitorder="little"))[: k - int(np.bitwise_count(sure).sum())]
    out = sure.copy()
    np.bitwise_or.at(out, rest >> 6, np.uint64(1) << (rest & 63).astype(np.uint64))
    return out


def _stack(lists) -> np.ndarray:
    """Rows of different lengths, filled up with zeros."""
    size = max((len(v) for v in lists), default=0)
    out = np.zeros((len(lists), size), np.int64)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def _search(k: int, bits: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if len(rows) and len(queries):
            ids = rows["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            x = _stack([rows["q"][int(i)].values.to_numpy() for i in order])
            asked = _stack([v.values.to_numpy() for v in queries["q"]])
            dims = max(x.shape[1], asked.shape[1])
            x, asked = (np.pad(v, ((0, 0), (0, dims - v.shape[1]))) for v in (x, asked))
            maps = slices(x + (1 << (bits - 1)), bits)
            inverse = ~maps
            live = np.packbits(np.arange(-(-len(x) // 64) * 64) < len(x), bitorder="little").view(np.uint64)
            for qid, q in zip(queries["query_id"].to_pylist(), asked):
                mine = live
                lo, hi = np.searchsorted(ids, [qid, qid + 1])
                if lo < hi:
                    mine = live.copy()
                    own = np.arange(lo, hi)
                    np.bitwise_and.at(mine, own >> 6, ~(np.uint64(1) << (own & 63).astype(np.uint64)))
                if not mine.any():
                    continue
                total, offset = weighted_sum(maps, inverse, q)
                best = np.flatnonzero(np.unpackbits(select(total, mine, k).view(np.uint8), bitorder="little"))
                at, bit = best >> 6, (best & 63).astype(np.uint64)
                score = sum((((s[at] >> bit) & np.uint64(1)).astype(np.int64) << e) for e, s in enumerate(total)) - offset if total else np.zeros(len(best), np.int64) - offset
                out[0] += [qid] * len(best)
                out[1] += ids[best].tolist()
                out[2] += score.tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("query_id", "vec_id", "score"), out)})

    return run


def top_k(vectors: DataFrame, queries: str, k: int = 5, scale: int = 256, block_rows: int = 1 << 16, group_queries: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest integer inner product with each query.

    vectors has vec_id (integer) and embedding (array of numbers); components become floor(scale * x),
    x as double. queries is an SQL condition that says which rows are queries; candidates are all rows
    but those of the query's vec_id. Ties go to the smaller vec_id; a query with fewer candidates
    has all of them. Vectors that are null or hold null or non-finite components, or a null vec_id,
    take no part; a shorter vector counts as filled up with zeros. Scores are 64-bit: components beyond
    the square root of 2**63 / dimensions, whose products might not fit, count as that bound. Other columns are not read.
    """
    ok = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    q = F.transform("embedding", lambda x: x.cast("double") * scale)
    v = durable(vectors.where(ok & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"), F.coalesce(F.expr(queries), F.lit(False)).alias("asked")))
    n, n_q, dims = v.agg(F.count("*"), F.count_if("asked"), F.max(F.size("q"))).first()
    bound = math.isqrt((1 << 63) // max(1, dims or 1)) - 1
    v = v.withColumn("q", F.transform("q", lambda x: F.floor(F.greatest(F.lit(-float(bound)), F.least(F.lit(float(bound)), x))).cast("long")))
    least, most = v.agg(F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    bits = max(int(-(least or 0) - 1).bit_length(), int(most or 0).bit_length(), 1) + 1
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-n_q // group_queries))
    rows = v.select("vec_id", "q", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
    asked = v.where("asked").select(F.col("vec_id").alias("query_id"), "q", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int").alias("grp"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    found = rows.groupBy("block", "grp").cogroup(asked.groupBy("block", "grp")).applyInArrow(_search(k, bits), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
