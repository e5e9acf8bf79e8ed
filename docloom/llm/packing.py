"""Packing into optimal length buckets.

The histogram of document lengths covers all documents; dynamic programming over it chooses the
bucket lengths that leave the least padding. Within a bucket, batches hold as many documents as the
token budget allows at the bucket's length. All lengths are exact in the histogram: d different lengths
take d**2 / 2 tokens of text at least, so that its entries are few beside the documents.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

WORD = r"[^\x20\x09-\x0D]+"


def optimal_buckets(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Of the distinct ascending lengths, the at most `buckets` upper bounds with the least padding.

    Padding is the sum over all documents of their bound less their length; of equally good
    choices, the one with fewer buckets. O(buckets * lengths), exact in integers: a bucket (i, j] costs
    x[j] * (c[j] - c[i]) - (s[j] - s[i]), so the best i for each j is on the lower hull of lines in x[j].
    """
    m = len(lengths)
    if not m:
        return []
    c = [0, *accumulate(counts)]
    s = [0, *accumulate(n * x for n, x in zip(counts, lengths))]
    best: list[int | None] = [0] + [None] * m
    back, padding = [], []
    while len(back) < min(buckets, m):
        hull: list[tuple[int, int, int]] = []  # slope, value at 0, i; slopes fall
        new: list[int | None] = [None] * (m + 1)
        came, at = [0] * (m + 1), 0
        for j, x in enumerate(lengths, 1):
            if best[j - 1] is not None:
                k, y = -c[j - 1], best[j - 1] + s[j - 1]
                while len(hull) > 1 and (y - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - k):
                    hull.pop()
                hull.append((k, y, j - 1))
                at = min(at, len(hull) - 1)
            if hull:
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                    at += 1
                new[j], came[j] = hull[at][0] * x + hull[at][1] + x * c[j] - s[j], hull[at][2]
        best = new
        back.append(came)
        padding.append(best[m])
    b, j, out = padding.index(min(padding)), m, []
    while j:
        out.append(lengths[j - 1])
        j, b = back[b][j], b - 1
    return out[::-1]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 65536, rows_per_chunk: int = 20_000) -> DataFrame:
    """(doc_id, n_tokens, bucket_length, batch, slot, padding) for every row of docs (doc_id, text).

    n_tokens counts the words [^\\x20\\x09-\\x0D]+ of the whole text, null and empty: 0. bucket_length is
    the least chosen length that holds the document; batch numbers the batches of that bucket from 0 and
    slot the documents in a batch from 0, in hashed order. A batch has max(1, budget // bucket_length)
    documents, the last of a bucket maybe fewer. No document is cut or left out: one that exceeds the
    budget is a batch of its own. Rows are numbered within chunks of bounded size, offset by the sizes of
    the chunks before; no bucket is gathered in one task. Other columns are not read.
    """
    n = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sized = durable(docs.select("doc_id", n.alias("n_tokens")).withColumn("length", F.greatest("n_tokens", F.lit(1))))
    histogram = sorted((r.length, r["count"]) for r in sized.groupBy("length").count().collect())
    bounds = optimal_buckets([v for v, _ in histogram], [c for _, c in histogram], buckets) or [1]
    chunks = max(1, -(-sum(c for _, c in histogram) // rows_per_chunk))
    bound = F.array_min(F.filter(F.array(*(F.lit(b).cast("long") for b in bounds)), lambda b: b >= F.col("length")))
    placed = sized.select("doc_id", "n_tokens", bound.alias("bucket_length"), F.xxhash64("doc_id", "n_tokens").alias("h")).withColumn("chunk", F.pmod("h", F.lit(chunks)))
    before = Window.partitionBy("bucket_length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("bucket_length", "chunk").agg(F.count("*").alias("c")).withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    order = Window.partitionBy("bucket_length", "chunk").orderBy("h", "doc_id", "n_tokens")
    at = F.col("offset") + F.col("k") - 1
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_length"))).cast("long")
    return (
        placed.withColumn("k", F.row_number().over(order))
        .join(offset, ["bucket_length", "chunk"])
        .select("doc_id", "n_tokens", "bucket_length", F.floor(at / per).cast("long").alias("batch"), F.pmod(at, per).cast("int").alias("slot"), (F.col("bucket_length") - F.col("n_tokens")).alias("padding"))
    )
