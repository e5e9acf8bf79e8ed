"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame operations only.

A document is contaminated by a benchmark item if a window of as many words as the item (the whole
document, if it is shorter) has a weighted Jaccard similarity of its word shingles of 0.8 or more
with the item's; a shingle's weight is its number of occurrences.

1. Windows of each item size are fingerprinted wherever they can reach the threshold with any item of
   that size: at least `need` of their shingles must occur in items of that size. Moving a window's
   start to its first such shingle loses none of them, so the windows that start there, and the
   document's last window, are all that matter. Nothing that qualifies is lost, and nothing is said
   yet of which item it is.
2. Windows and items get 64-bit SimHash fingerprints, cut into 8 blocks of 8 bits. Two fingerprints
   within `radius` bits agree in some block but for radius // 8 bits at most, so an item is entered in the
   multi-index under all such neighbours of its blocks' values, and a window probes its own 8 values:
   that guarantees all fingerprints within the radius. At similarity 0.8 a pair differs in 9.7 +- 2.9
   bits on average; the radius of 23 is more than 4 deviations off.
3. Pairs within the radius are verified exactly on their weighted shingles.

Benchmark tables and hits are broadcast only if they have at most `broadcast_rows` rows, else joined.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, internal

SIZE, PERCENT, RADIUS = 5, 80, 23
BLOCK, BLOCKS = 8, 8


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(w: Column, size: int) -> Column:
    """Hashes of all runs of `size` words, by position."""
    return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))).otherwise(F.array().cast("array<long>"))


def simhash(name: str) -> Column:
    """64-bit SimHash of the column `name`, an array of 64-bit hashes, each as often as it occurs.

    A long holds the counts of bits j and j + 32 side by side, so 32 of them count all bits.
    """
    lanes = f"aggregate(`{name}`, array_repeat(0L, 32), (a, x) -> transform(a, (v, j) -> v + (shiftrightunsigned(x, j) & 4294967297L)))"
    low = f"if((v & 4294967295L) * 2 > size(`{name}`), shiftleft(1L, j), 0L)"
    high = f"if(shiftrightunsigned(v, 32) * 2 > size(`{name}`), shiftleft(1L, j + 32), 0L)"
    return F.expr(f"aggregate(transform({lanes}, (v, j) -> {low} | {high}), 0L, (a, b) -> a | b)")


def hamming_blocks(fingerprint: Column) -> Column:
    """Array of (number, value) of the blocks of a 64-bit fingerprint: what a window probes."""
    return F.array(*(F.struct(F.lit(k).alias("number"), F.shiftrightunsigned(fingerprint, k * BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1).cast("long")).alias("value")) for k in range(BLOCKS)))


def near_blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """Array of (number, value) under which an item is entered: its blocks' values but for radius // BLOCKS bits at most."""
    masks = F.array(*(F.lit(m).cast("long") for m in range(1 << BLOCK) if m.bit_count() <= radius // BLOCKS))
    return F.flatten(F.transform(hamming_blocks(fingerprint), lambda b: F.transform(masks, lambda m: F.struct(b["number"].alias("number"), b["value"].bitwiseXOR(m).alias("value")))))


def _common(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    both = F.array_intersect(a, b)
    counted = F.aggregate(both, F.lit(0), lambda t, x: t + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))
    return F.when(plain, F.size(both)).otherwise(counted)


def _small(df: DataFrame, rows: int, most: int) -> DataFrame:
    return F.broadcast(df) if rows <= most else df


def _windows(base: DataFrame, grams: DataFrame, k: int, percent: int, most: int) -> DataFrame:
    """(doc_id, text_hash, k, m, n, start, size): windows of item size m (n shingles of k words) that hold enough of such items' shingles.

    size is the window's number of shingles. Of a document only positions are gathered, once each.
    """
    some = base.select("doc_id", "text_hash", F.size("w").alias("words"), F.posexplode_outer(_shingles(F.col("w"), k)).alias("p", "h"))  # outer: else a filter would be computed below, from the text anew for each word
    hits = some.join(grams.drop("k"), "h").groupBy("doc_id", "text_hash", "words", "m", "n").agg(F.array_sort(F.collect_set("p")).alias("s"))
    size = F.least(F.col("n"), F.col("words") - (k - 1))
    hits = hits.withColumn("size", size).withColumn("need", F.ceil(F.lit(percent) * (F.col("n") + F.col("size")) / (100 + percent)).cast("int"))
    last = F.col("words") - (k - 1) - F.col("size")  # start of the document's last window
    # the hit need - 1 places on lies within the window; for the last window, so do need hits before the document's end
    inner = lambda p, j: (p <= last) & (F.get("s", j + F.col("need") - 1) < p + F.col("size"))
    starts = F.filter("s", lambda p, j: F.coalesce(inner(p, j), F.lit(False)))
    tail = F.when(F.get("s", F.size("s") - F.col("need")) >= last, F.array(last)).otherwise(F.array().cast("array<int>"))
    starts = F.when(F.size("s") >= F.col("need"), F.array_union(starts, tail))
    return hits.select("doc_id", "text_hash", F.lit(k).alias("k"), "m", "n", "size", F.explode(starts).alias("start"))


def matches(docs: DataFrame, items: DataFrame, percent: int = PERCENT, radius: int = RADIUS, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity): the best window of each contaminated row and item.

    docs has doc_id and text, items item_id and text. text_hash tells rows of one doc_id apart.
    Null, empty and wordless texts and items match nothing. Items of fewer than 5 words have their
    whole sequence as one shingle. A null item_id is an item like others; several texts of one item_id
    are compared each on its own, and the best one counts. Other columns are not read.
    """
    w = items.select("item_id", words(F.col("text")).alias("iw")).where("size(iw) > 0")
    w = w.withColumn("k", F.least(F.lit(SIZE), F.size("iw")))
    by_size = F.array().cast("array<long>")
    for k in range(SIZE, 0, -1):
        by_size = F.when(F.col("k") == k, _shingles(F.col("iw"), k)).otherwise(by_size)
    bench = durable(w.select("item_id", F.size("iw").alias("m"), "k", by_size.alias("ih")).dropDuplicates(["item_id", "ih"]).withColumns({"ifp": simhash("ih"), "iid": F.xxhash64("item_id", "ih")}))
    sizes = sorted((r.k for r in bench.select("k").distinct().collect()), reverse=True)
    if not sizes:
        return docs.select("doc_id", F.xxhash64("text").alias("text_hash")).limit(0).withColumn("item_id", F.lit(None).cast(items.schema["item_id"].dataType)).withColumn("similarity", F.lit(None).cast("double"))
    grams = durable(bench.select("m", "k", F.size("ih").alias("n"), F.explode("ih").alias("h")).distinct())
    n_grams, n_items = grams.count(), bench.count()
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    spots = None
    for k in sizes:
        one = _windows(base, _small(grams.where(F.col("k") == k), n_grams, broadcast_rows), k, percent, broadcast_rows)
        spots = one if spots is None else spots.unionByName(one)
    spots = durable(spots)
    where = spots.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("k", "m", "n", "size", "start")).alias("spots")).withColumnsRenamed({"doc_id": "d", "text_hash": "t"})
    # the documents once more, those with windows only
    found = base.join(_small(where, spots.count(), broadcast_rows), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
    windows = None
    for k in sizes:
        mine = F.filter("spots", lambda x: x["k"] == k)
        one = found.select("doc_id", "text_hash", _shingles(F.col("w"), k).alias("dh"), mine.alias("spots")).where("size(spots) > 0")
        one = one.select("doc_id", "text_hash", "dh", F.explode("spots").alias("x")).select("doc_id", "text_hash", F.lit(k).alias("wk"), F.col("x.m").alias("wm"), F.slice("dh", F.col("x.start") + 1, F.col("x.size")).alias("wh"))
        windows = one if windows is None else windows.unionByName(one)
    windows = durable(windows.distinct().withColumn("fp", simhash("wh")))  # also keeps the fingerprint from being computed once for each block
    index = bench.select("iid", "m", "k", "ifp", F.explode(near_blocks(F.col("ifp"), radius)).alias("b")).select("iid", "m", "k", "ifp", F.col("b.number").alias("number_i"), F.col("b.value").alias("value_i"))
    entries = n_items * BLOCKS * sum(math.comb(BLOCK, i) for i in range(radius // BLOCKS + 1))
    left = windows.withColumn("b", F.explode(hamming_blocks(F.col("fp")))).withColumns({"number": F.col("b.number"), "value": F.col("b.value")})
    near = left.join(_small(index, entries, broadcast_rows), (F.col("wm") == F.col("m")) & (F.col("wk") == F.col("k")) & (F.col("number") == F.col("number_i")) & (F.col("value") == F.col("value_i")))
    # a pair that meets in several blocks is looked at in the first of them only
    differ = F.col("fp").bitwiseXOR(F.col("ifp"))
    first = F.array_min(F.transform(F.filter(hamming_blocks(differ), lambda b: F.bit_count(b["value"]) <= radius // BLOCKS), lambda b: b["number"]))
    near = near.where((F.bit_count(differ) <= radius) & (first == F.col("number"))).select("doc_id", "text_hash", "wh", "iid")
    near = near.join(_small(bench.select("iid", "item_id", "ih"), n_grams, broadcast_rows), "iid")
    both = _common(F.col("wh"), F.col("ih"))
    sim = both / (F.size("wh") + F.size("ih") - both)
    return near.withColumn("similarity", sim).where(F.col("similarity") * 100 >= percent).groupBy("doc_id", "text_hash", "item_id").agg(F.max("similarity").alias("similarity"))


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, similarity) for every row of docs.

    item_ids are the matching items in ascending order, similarity is the best one's (null if clean).
    """
    found = matches(docs, items, **options).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("similarity"))
    found = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "item_ids", "similarity")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    found = durable(found)
    out = rows.join(_small(found, found.count(), 100_000), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")), "left")
    none = F.array().cast(found.schema["item_ids"].dataType)
    return out.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce(F.size("item_ids"), F.lit(0)).alias("n_items"), F.coalesce("item_ids", none).alias("item_ids"), "similarity").withColumn("n_items", F.greatest("n_items", F.lit(0)))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """docs without the rows that hold a benchmark item; all columns as they were."""
    d, t = internal(docs, "_gone_doc"), internal(docs, "_gone_text")
    found = durable(matches(docs, items, **options).select(F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct())
    return docs.join(_small(found, found.count(), 100_000), F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(t)), "left_anti")
