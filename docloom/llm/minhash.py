"""Near-duplicate documents by MinHash with sequential Bayesian verification.

1. Documents with one and the same shingle set are one class, whatever their number.
2. Bands of `rows` MinHash values propose candidates; with 24 bands of 4 rows a pair of
   similarity 0.8 is missed with probability (1 - 0.8**4)**24 = 3e-6.
3. Classes that are connected by shared bands are a cluster. Clusters are compared in blocks of
   bounded size: signature batches are compared one after another, and a pair is given up as soon
   as the posterior probability of reaching the threshold falls below `miss`, and so late that a
   pair at the threshold is given up with a probability of `miss` at most.
4. Survivors are verified exactly on their full shingle sets. A block returns a star for each
   of its components, never its pairs, so copies do not multiply rows.
5. A cluster of more than one block is first compared within its parts only, each with HUBS sets of
   the cluster among it, which join near copies of all parts. Only sets that are not joined to the
   hub with the most sets are then compared with the whole cluster: among the others
   every further link would join what is joined already.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytecode as B
from .common import components, durable, internal

BANDS, ROWS, BATCH = 24, 4, 16
HUBS = 8
BROADCAST_ROWS = 1_000_000
_MUL = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of one non-empty set, BANDS * ROWS of 64 bits."""
    out = None
    for c in range(0, len(shingles), 512):
        m = np.multiply.outer(_MUL, shingles[c : c + 512]).min(1)
        out = m if out is None else np.minimum(out, m)
    return out


def bands(sigs: np.ndarray) -> np.ndarray:
    """Band keys of signatures (n, BANDS * ROWS)."""
    s = B.mix(sigs.reshape(len(sigs), BANDS, ROWS))
    k = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        k = B.mix(k * np.uint64(3) + s[:, :, r])
    return k


@lru_cache
def least_matches(threshold: float, miss: float, n: int) -> tuple[int, ...]:
    """For each number of compared values BATCH, 2 * BATCH, ... n: the fewest matches with which
    P(similarity >= threshold | matches) is at least `miss`, under a uniform prior, or fewer: over all
    numbers together, a pair at the threshold has fewer matches with a probability of `miss` at most."""
    x = (np.arange(20000) + 0.5) / 20000
    out = []
    share = miss / (n // BATCH)
    for k in range(BATCH, n + 1, BATCH):
        for m in range(k + 1):
            logp = m * np.log(x) + (k - m) * np.log1p(-x)
            p = np.exp(logp - logp.max())
            if p[x >= threshold].sum() >= miss * p.sum():
                break
        below = np.cumsum([comb(k, i) * threshold**i * (1 - threshold) ** (k - i) for i in range(m)])
        out.append(int((below <= share).sum()))
    return tuple(out)


def _features(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = B.flat(batch.column(1))
            for i, j in B.pieces(offs):
                h, o = B.shingles(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                n = np.diff(o)
                full = np.flatnonzero(n)
                node, keys = np.zeros(j - i, np.uint64), [None] * (j - i)
                if len(full):
                    sigs = np.stack([signature(h[o[d] : o[d + 1]]) for d in full])
                    node[full] = set_id(h, o[full], n[full])
                    for d, b in zip(full, bands(sigs)):
                        keys[d] = b.view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(n, pa.int64()), pa.array(node.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "text_hash", "n_shingles", "node", "keys"])

    return run


def set_id(h: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit ids of the non-empty sets at h[start:start+n]."""
    c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(B.mix(h + np.uint64(0x1B873593)))))
    return B.mix(c[start + n] - c[start] + n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _named(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = B.flat(batch.column(0))
            for i, j in B.pieces(offs):
                h, o = B.shingles(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
                full = np.flatnonzero(np.diff(o))
                if len(full):
                    ids = set_id(h, o[full], np.diff(o)[full])
                    yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), batch.column(0).slice(i, j - i).take(pa.array(full))], ["node", "text"])

    return run


def sets_of(texts: pa.ChunkedArray, k: int) -> list[np.ndarray]:
    """The shingle sets of texts that all have words."""
    out: list[np.ndarray] = []
    for chunk in texts.chunks:
        buf, offs = B.flat(chunk)
        for i, j in B.pieces(offs):
            h, o = B.shingles(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], k)
            out += [h[a:b] for a, b in zip(o, o[1:])]
    return out


def links_within(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, num: int, den: int, miss: float) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets[left], or between sets[left] and sets[right].

    Bayesian pruning of signature batches first, then exact intersection sizes: for few survivors
    pair by pair, else by a product of indicator matrices over the shingles that occur twice.
    """
    sigs = np.stack([signature(s) for s in sets])
    keys, small = bands(sigs), (B.mix(sigs) >> np.uint64(48)).astype(np.uint16)
    size = np.array([len(s) for s in sets])
    least = least_matches(num / den, miss, small.shape[1])
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    cols = left if right is None else right
    shared = None
    for at, a in enumerate(left):
        rest = cols[at + 1 :] if right is None else cols
        if not len(rest):
            continue
        lo, hi = np.minimum(size[rest], size[a]), np.maximum(size[rest], size[a])
        rest = rest[den * lo >= num * hi]
        rest = rest[(keys[rest] == keys[a]).any(1)]
        got = np.zeros(len(rest), np.int64)
        for b, need in enumerate(least):
            got += (small[rest, b * BATCH : (b + 1) * BATCH] == small[a, b * BATCH : (b + 1) * BATCH]).sum(1)
            ok = got >= need
            rest, got = rest[ok], got[ok]
        if not len(rest):
            continue
        ra = root(a)
        rest = np.array([x for x in rest.tolist() if root(x) != ra], np.int64)
        if not len(rest):
            continue
        if shared is None:
            shared = _positions(sets)
        vocab, ids = shared
        mark = np.zeros(vocab, bool)
        mark[ids[a]] = True
        for x in rest.tolist():
            both = int(mark[ids[x]].sum())
            if den * both >= num * (size[a] + size[x] - both):
                rx, ra = root(x), root(a)
                if rx != ra:
                    parent[rx] = ra
                    out.append((int(a), x))
    return out


def _positions(sets: list[np.ndarray]) -> tuple[int, list[np.ndarray]]:
    """Number of shingles that occur at least twice, and each set's as dense numbers."""
    every = np.concatenate(sets)
    u, inv, n = np.unique(every, return_inverse=True, return_counts=True)
    dense = np.cumsum(n > 1) - 1
    twice = n > 1
    cut = np.cumsum([0, *(len(s) for s in sets)])
    return int(twice.sum()), [dense[inv[i:j]][twice[inv[i:j]]] for i, j in zip(cut, cut[1:])]


def stars(n: int, forest: list[tuple[int, int]], hub: np.ndarray) -> Iterator[tuple[int, int]]:
    """(top, member) for every member, top included, of each tree of a forest on n nodes: top is its first hub, else its first member."""
    trees: dict[int, list[int]] = {}
    tree = list(range(n))
    for x, y in forest:
        small, large = sorted((tree[x], tree[y]), key=lambda t: len(trees.get(t, ())))
        moved = trees.pop(small, [small])
        trees.setdefault(large, [large]).extend(moved)
        for m in moved:
            tree[m] = large
    for members in trees.values():
        top = min(members, key=lambda m: (not hub[m], m))
        yield from ((top, m) for m in members)


def _blocks(k: int, num: int, den: int, miss: float):
    def run(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        cluster, part, i = (table[c].to_numpy() for c in ("cluster", "part", "i"))
        j = table["j"].to_numpy()
        hub = table["hub"].to_numpy()
        members = sets_of(table["text"], k)
        name = [table["name"].combine_chunks().field(n) for n in range(3)]
        a, b = [], []
        order = np.argsort(cluster, kind="stable")
        cut = np.flatnonzero(np.concatenate(([True], np.diff(cluster[order]) != 0, [True])))
        for s, e in zip(cut, cut[1:]):
            rows = order[s:e]
            rows = rows[np.argsort(node[rows], kind="stable")]
            sets = [members[r] for r in rows]
            at = np.arange(len(rows))
            if i[rows[0]] == j[rows[0]]:
                found = links_within(sets, at, None, num, den, miss)
            else:
                side = part[rows] == i[rows]
                found = links_within(sets, at[side], at[~side], num, den, miss)
            for top, x in stars(len(rows), found, hub[rows]):
                a.append(rows[top])
                b.append(rows[x])
        return pa.table({n: pa.StructArray.from_arrays([f.take(pa.array(at, pa.int64())) for f in name], ["none", "label", "node"]) for n, at in (("a", a), ("b", b))})

    return run


_NAME = "struct<none: boolean, label: bigint, node: bigint>"


def _found(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = 1e-6, block: int = 1024, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for every row of docs, see near_duplicates()."""
    pair = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    feats = durable(pair.mapInArrow(_features(shingle), "doc_id long, text_hash long, n_shingles long, node long, keys array<long>"))
    full = feats.where("n_shingles > 0")
    classes = full.groupBy("node").agg(F.min("doc_id").alias("label"), F.first("keys").alias("keys"))
    keyed = classes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("key", "a")
    touching = keyed.join(shared, "key").where("a <> node").select("a", F.col("node").alias("b"))
    clusters = components(touching).withColumnRenamed("root", "cluster")
    # a class goes by the least doc_id in it, so that the least name that it reaches names the component
    name = F.struct(F.col("label").isNull().alias("none"), "label", "node")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    named = durable(classes.select("node", "label").join(clusters, "node").join(sizes, "cluster").select("node", name.alias("name"), "cluster", "chunks"))
    count, most = named.agg(F.count("*"), F.max("chunks")).first()
    bins = max(1, count // 512)
    compared = f"a {_NAME}, b {_NAME}"

    def blocks(rows: DataFrame) -> DataFrame:
        """The links that the blocks of rows (node, name, cluster, chunks, hub, part, i, j) hold."""
        some = rows.select(F.col("name.label").alias("doc_id")).distinct()
        some = F.broadcast(some) if count <= broadcast_rows else some
        texts = pair.join(some, pair.doc_id.eqNullSafe(some.doc_id), "left_semi").select("text")
        # texts and not sets, since they take half the bytes in a shuffle
        sets = texts.mapInArrow(_named(shingle), "node long, text string").dropDuplicates(["node"])
        grp = F.when(F.col("chunks") > 1, F.xxhash64("cluster", "i", "j")).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(bins)))
        put = sets.join(rows, "node").select(grp.alias("grp"), "node", "name", "cluster", "hub", "part", "i", "j", "text")
        return durable(put.groupBy("grp", F.when(F.col("i") == F.col("j"), 0).otherwise(1).alias("kind")).applyInArrow(_blocks(shingle, percent, 100, miss), compared))

    # first each part by itself, with the hubs of its cluster among it
    own = named.select("*", F.lit(False).alias("hub"), F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("part"))
    big = own.where("chunks > 1")
    hubs = big.groupBy("cluster", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(HUBS))).agg(F.min_by(F.struct(*named.columns), F.col("node")).alias("at"))
    spread = hubs.select("at.*", F.lit(True).alias("hub")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    links = blocks(own.unionByName(spread).withColumn("i", F.col("part")).withColumn("j", F.col("part")))
    if (most or 1) > 1:
        # then what is not linked to the hub with the most links, against all of a large cluster
        tops = links.groupBy(F.col("b.node").alias("node")).agg(F.min("a.node").alias("top"))
        reached = big.join(tops, "node", "left")
        main = reached.groupBy("cluster", "top").agg(F.count("top").alias("n")).groupBy("cluster").agg(F.max_by("top", F.struct("n", "top")).alias("main"))
        sided = reached.join(main, "cluster").withColumn("rest", ~F.coalesce(F.col("top") == F.col("main"), F.lit(False)))
        n_rest, n_main = F.count(F.when(F.col("rest"), 1)), F.count(F.when(~F.col("rest"), 1))
        counts = sided.groupBy("cluster").agg(F.ceil(n_rest / block).cast("int").alias("rests"), F.ceil(n_main / block).cast("int").alias("mains")).where("rests > 0")
        spot = F.xxhash64("node")
        part = F.when(F.col("rest"), F.pmod(spot, F.col("rests"))).otherwise(F.col("rests") + F.pmod(spot, F.col("mains"))).cast("int")
        other = F.when(F.col("rest"), F.col("rests") + F.col("mains")).otherwise(F.col("rests")) - 1
        across = sided.join(counts, "cluster").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), other)))
        across = across.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
        links = links.unionByName(blocks(across.select(*own.columns, "i", "j")))
    least = components(links).select(F.col("node.node").alias("node"), F.col("root.label").alias("least"), F.lit(True).alias("linked"))
    final = durable(classes.select("node", "label").join(least, "node", "left").select("node", F.when(F.col("linked"), F.col("least")).otherwise(F.col("label")).alias("component")))
    # one row for each class on the right, so that adaptive execution can split a class of many copies
    out = full.select("doc_id", "text_hash", "n_shingles", "node").join(final, "node", "left").drop("node")
    out = out.unionByName(feats.where("n_shingles = 0").select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component")))
    return out.select("doc_id", "text_hash", "n_shingles", F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs (doc_id long, text string).

    Options: shingle (5 words), percent (80), miss (1e-6), block (1024 sets),
    broadcast_rows (ids of compared documents that are broadcast to find their texts; more are joined by
    a shuffle of the texts). Links are exact:
    100 * intersection >= percent * union of the documents' sets of distinct word shingles.
    component_id is the smallest doc_id reachable over links, itself included.
    Null and empty texts, and texts without words, have an empty set and no links. Rows that share
    a doc_id are separate documents. A row with null doc_id takes part; a component of such rows
    only has a null component_id and keeps all of them. Columns other than doc_id and text are not read.
    """
    return _found(docs, **options).drop("text_hash")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs without the rows whose component of near duplicates keeps another doc_id.

    The rows of each component that have its smallest doc_id stay: one, unless several rows of that
    doc_id are alike. Rows are told apart by doc_id and text: of a doc_id with several texts, only those
    go whose own component keeps another doc_id. Rows with null doc_id go if their component has a doc_id.
    """
    d, t = internal(docs, "_gone_doc"), internal(docs, "_gone_text")
    gone = _found(docs, **options).where(~F.col("kept")).select(F.col("doc_id").alias(d), F.col("text_hash").alias(t)).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64(F.col("text").cast("string")) == F.col(t)), "left_anti")
