"""Repeated byte substrings by merging the Burrows-Wheeler transforms of shards.

All 100-byte strings of the corpus are dealt to buckets by content: a string belongs to the bucket
of its least k-gram, so equal strings meet without a global suffix sort. The strings around one
occurrence of a least k-gram overlap and travel as one segment.

1. Blocks of documents send the hashes of their distinct segments to the buckets. What repeats an earlier
   segment of its own block throughout is compared with it byte by byte and need not be sent.
2. A bucket answers each block: segments whose k-gram occurs nowhere else need nothing; for all others
   it asks for the bytes. These hashes only route: they decide of no repeat.
3. There the bytes are cut into shards. Each shard's transform is built on its own; then the shards
   are merged by iterative interleave refinement (Holt & McMillan 2014): every round sorts stably by
   the next transform symbol and so lengthens the known common prefix of all neighbours by one
   symbol, without comparing or sorting suffixes again. Neighbours that are not told apart after
   the last round share 100 bytes: they are the repeated intervals, whole equal segments included.
4. The answers return to the blocks, which cut the covered bytes out of their documents.

Symbols are 50-byte grams, each segment giving 50 phases, so that two rounds reach 100 bytes; shorter ones
need more rounds and give the same result.
What blocks send is distinct within the block, so that a passage in a third of all documents costs
one row a block. Only a k-gram with more than `hot` segments would crowd its bucket: if they are all
equal, their 64-bit content hashes decide, else they are dealt out anew by the content of each
100-byte string, and two 64-bit hashes decide.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytecode as B
from .common import internal, width

SPAN, GRAM, SYMBOL = 100, 40, 50
MADE = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
_STEP, _MASK = 1 << 18, np.uint64((1 << 20) - 1)


def segments(buf: np.ndarray, offs: np.ndarray, span: int = SPAN, k: int = GRAM) -> tuple[np.ndarray, ...]:
    """Start, end (of window starts), k-gram hash and content hash of the segments, by position.

    A segment is a maximal run of windows of `span` bytes that lie within one document and share
    the occurrence of their least k-gram.
    """
    n = len(buf)
    out = []
    stop = np.repeat(offs[1:].astype(np.int32), np.diff(offs))
    for a in range(0, n - span + 1, _STEP):
        b = buf[a : a + _STEP + span - 1]
        p = B.prefix(b)
        g = B.gram_hash(p, k)
        at = np.arange(len(g), dtype=np.uint64)
        least = (B.sliding_min((g & ~_MASK) | at, span - k + 1) & _MASK).astype(np.int64)
        m = len(least)
        ok = stop[a : a + m] - np.arange(a, a + m) >= span
        new = np.empty(m + 1, bool)
        new[0] = new[-1] = True
        new[1:-1] = (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])
        cut = np.flatnonzero(new)
        s, e = cut[:-1], cut[1:]
        live = ok[s]
        s, e = s[live], e[live]
        out.append((s + a, e + a, g[least[s]], B.span_hash(p, s, e - 1 + span)))
    if not out:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(*out))


class Block:
    """The documents of one block in order of doc_id, their segments and distinct entries."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, buckets: int):
        ids = table[id_col].cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy()
        order = np.argsort(ids, kind="stable")
        if len(np.unique(ids)) < len(ids):  # rows of one doc_id: by text
            text = table[text_col].to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda r: (ids[r], text[r] or "")), np.int64)
        self.table, self.ids = table.take(pa.array(order)), ids[order]
        self.buf, self.offs = B.flat(self.table[text_col])
        self.start, self.end, self.h, c = segments(self.buf, self.offs)
        key = B.mix(self.h ^ (c << B.U(1)))
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        self.again = np.zeros(len(key), bool)
        self.again[self._equal(np.setdiff1d(np.arange(len(key)), first), first, inverse)] = True
        by = np.flatnonzero(~self.again)
        bucket = ((self.h[by] >> B.U(20)) % B.U(buckets)).astype(np.int64)
        by = by[np.argsort(bucket, kind="stable")]
        self.entry, self.c = by, c
        self.at = np.searchsorted(np.sort(bucket), np.arange(buckets + 1))

    def _equal(self, e: np.ndarray, first: np.ndarray, inverse: np.ndarray) -> np.ndarray:
        """Those of the segments e that equal the first one of their key byte by byte."""
        lead = first[inverse[e]]
        size = self.end[e] - self.start[e]
        ok = size == self.end[lead] - self.start[lead]
        e, lead, size = e[ok], lead[ok], size[ok] + SPAN - 1
        out = []
        for i in range(0, len(e), 4096):
            n = size[i : i + 4096]
            at = np.cumsum(n) - n
            off = np.arange(n.sum()) - np.repeat(at, n)
            same = self.buf[np.repeat(self.start[e[i : i + 4096]], n) + off] == self.buf[np.repeat(self.start[lead[i : i + 4096]], n) + off]
            out.append(e[i : i + 4096][np.logical_and.reduceat(same, at)])
        return np.concatenate([*out, np.empty(0, np.int64)])

    def doc(self, entry: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.offs, self.start[entry], "right") - 1]


def _send(id_col, text_col, block_col, buckets):
    def run(table: pa.Table) -> pa.Table:
        number = table[block_col][0].as_py()
        x = Block(table, id_col, text_col, buckets)
        h, c, doc = x.h[x.entry], x.c[x.entry], x.doc(x.entry)
        full = np.flatnonzero(np.diff(x.at))
        cut = [(x.at[b], x.at[b + 1]) for b in full]
        return pa.table({"bucket": pa.array(full, pa.int32()), "block": pa.array([number] * len(full), pa.int64()), **{n: pa.array([v[i:j].tobytes() for i, j in cut], pa.binary()) for n, v in (("h", h), ("c", c), ("doc", doc))}})

    return run


def _gather(table: pa.Table, **kinds) -> tuple[np.ndarray, ...]:
    """Row number of each entry, and the named binary columns as arrays end to end."""
    out = [np.frombuffer(b"".join(table[n].to_pylist()), t) for n, t in kinds.items()]
    n, t = next(iter(kinds.items()))
    return np.repeat(np.arange(len(table)), [len(v) // np.dtype(t).itemsize for v in table[n].to_pylist()]), *out


def _answer(hot: int):
    def run(table: pa.Table) -> pa.Table:
        row, h, c, doc = _gather(table, h=np.uint64, c=np.uint64, doc=np.int64)
        local = np.arange(len(row)) - np.searchsorted(row, np.arange(len(table)))[row]
        order = np.argsort(h, kind="stable")
        hs = h[order]
        first = np.flatnonzero(np.concatenate(([True], hs[1:] != hs[:-1])))
        size = np.diff(np.append(first, len(hs)))
        many = np.repeat(size > 1, size)
        order = order[many]
        out = {n: [] for n in ("bucket", "block", "gone", "ask", "deal")}
        if len(order):
            hs = h[order]
            first = np.flatnonzero(np.concatenate(([True], hs[1:] != hs[:-1])))
            size = np.diff(np.append(first, len(hs)))
            same = np.minimum.reduceat(c[order], first) == np.maximum.reduceat(c[order], first)
            lowest = np.minimum.reduceat(doc[order], first)
            gone = np.repeat(same & (size > hot), size) & (doc[order] != np.repeat(lowest, size))
            deal = np.repeat(~same & (size > hot), size)
            ask = np.repeat(size <= hot, size)
            bucket, block = table["bucket"][0].as_py(), table["block"].to_pylist()
            picks = []
            for m in (gone, ask, deal):
                e = np.sort(order[m])
                picks.append(np.split(local[e].astype(np.uint32), np.searchsorted(row[e], np.arange(1, len(table)))))
            for r, three in enumerate(zip(*picks)):
                if any(map(len, three)):
                    out["bucket"].append(bucket)
                    out["block"].append(block[r])
                    for n, v in zip(("gone", "ask", "deal"), three):
                        out[n].append(v.tobytes())
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "block": pa.array(out["block"], pa.int64()), **{n: pa.array(out[n], pa.binary()) for n in ("gone", "ask", "deal")}})

    return run


_DETAIL = "bucket int, block long, kind int, home binary, idx binary, h binary, c binary, doc binary, n binary, body binary"
_DETAIL_TYPES = {"bucket": pa.int32(), "block": pa.int64(), "kind": pa.int32(), **dict.fromkeys(("home", "idx", "h", "c", "doc", "n", "body"), pa.binary())}


def _detail(id_col, text_col, block_col, buckets):
    """kind 0: segments with their bytes; 1: single windows by their hashes; 2: answers to return as they are."""

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if len(docs) and len(replies):
            x = Block(docs, id_col, text_col, buckets)
            block = docs[block_col][0].as_py()
            hot = []
            for b, gone, ask, deal in zip(*(replies[n].to_pylist() for n in ("bucket", "gone", "ask", "deal"))):
                if gone:
                    rows.append((b, block, 2, b"", gone, b"", b"", b"", b"", b""))
                if ask:
                    idx = np.frombuffer(ask, np.uint32)
                    e = x.entry[x.at[b] + idx]
                    size = x.end[e] - x.start[e]
                    body = b"".join(x.buf[i : j + SPAN - 1].tobytes() for i, j in zip(x.start[e], x.end[e]))
                    rows.append((b, block, 0, b"", ask, x.h[e].tobytes(), x.c[e].tobytes(), x.doc(e).tobytes(), size.astype(np.uint16).tobytes(), body))
                if deal:
                    idx = np.frombuffer(deal, np.uint32)
                    e = x.entry[x.at[b] + idx]
                    size = x.end[e] - x.start[e]
                    off = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    hot.append((np.repeat(x.start[e], size) + off, np.repeat(x.doc(e), size), np.full(size.sum(), b, np.uint32), np.repeat(idx, size), off.astype(np.uint16)))
            if hot:
                pos, doc, home, idx, off = (np.concatenate(v) for v in zip(*hot))
                f1, f2 = np.empty(len(pos), np.uint64), np.empty(len(pos), np.uint64)
                order = np.argsort(pos, kind="stable")
                at = 0
                while at < len(order):  # hash them by stretches of the block
                    a = pos[order[at]]
                    to = int(np.searchsorted(pos[order], a + _STEP))
                    p = B.prefix(x.buf[a : a + _STEP + SPAN])
                    o = order[at:to]
                    s = pos[o] - a
                    f1[o], f2[o] = B.span_hash(p, s, s + SPAN), B.span_hash(p, s, s + SPAN // 2)
                    at = to
                to = (f1 % B.U(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                    rows.append((int(to[part[0]]), block, 1, home[part].tobytes(), idx[part].tobytes(), f1[part].tobytes(), f2[part].tobytes(), doc[part].tobytes(), off[part].tobytes(), b""))
        cols = list(zip(*rows)) or [[]] * len(_DETAIL_TYPES)
        return pa.table({n: pa.array(list(v), t) for (n, t), v in zip(_DETAIL_TYPES.items(), cols)})

    return run


def _dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


def _radix(key: np.ndarray) -> np.ndarray:
    """Stable argsort of int32 keys in two linear passes."""
    o = np.argsort((key & 0xFFFF).astype(np.uint16), kind="stable")
    if len(key) and key.max() > 0xFFFF:
        o = o[np.argsort((key[o] >> 16).astype(np.uint16), kind="stable")]
    return o


def shard_order(symbol: np.ndarray, following: np.ndarray, nodes: np.ndarray, depth: int) -> np.ndarray:
    """One shard's nodes in the order of their next `depth` symbols, by prefix doubling."""
    where = np.empty(len(symbol), np.int64)
    where[nodes] = np.arange(len(nodes))
    nxt, rank = where[following[nodes]], symbol[nodes].astype(np.int64)
    base, jump, done = rank, nxt, 1
    while done * 2 <= depth:
        rank = _dense(rank * (len(rank) + rank.max() + 2) + rank[jump])
        jump, done = jump[jump], done * 2
    while done < depth:
        rank = _dense(rank * (len(rank) + base.max() + 2) + base[jump])
        jump, done = nxt[jump], done + 1
    return nodes[np.argsort(rank, kind="stable")]


def merge_transforms(symbol: np.ndarray, before: np.ndarray, shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the shards' transforms by interleave refinement.

    symbol: first symbol of each node; before: the node cyclically in front of each; shards: each
    shard's nodes in their own sorted order. Returns all nodes in merged order, and for each but
    the first the length of the prefix it shares with its predecessor, as far as depth.
    """
    total = sum(map(len, shards))
    cat = np.concatenate(shards)
    bwt = symbol[before[cat]].astype(np.int32)
    from_shard = np.repeat(np.arange(len(shards)), [len(s) for s in shards]).astype(np.uint8 if len(shards) < 256 else np.uint16 if len(shards) < 65536 else np.int64)
    z, group = from_shard, np.zeros(total, np.int32)
    lcp = np.full(total, depth, np.int16)
    for done in range(depth):
        read = np.argsort(z, kind="stable")  # z's entries of shard 0, of shard 1, ...: these read bwt in order
        sym = np.empty(total, np.int32)
        sym[read] = bwt
        order = _radix(sym)
        z, s, g = z[order], sym[order], group[order]
        split = np.ones(total, bool)
        split[1:] = (s[1:] != s[:-1]) | (g[1:] != g[:-1])
        group = np.cumsum(split, dtype=np.int32) - 1
        lcp[split & (lcp == depth)] = done
    merged = np.empty(total, np.int64)
    merged[np.argsort(z, kind="stable")] = cat
    return merged, lcp


def repeats(body: np.ndarray, size: np.ndarray, rank: np.ndarray, span: int = SPAN, q: int = SYMBOL, shard_bytes: int = 1 << 17) -> np.ndarray:
    """For segments of size[i] windows end to end in body: which windows have an equal of lower rank.

    Returns a boolean for each window, segment after segment.
    """
    length = size + span - 1
    at = np.cumsum(length) - length
    pos = np.arange(len(body))
    seg = np.repeat(np.arange(len(size)), length)
    off = pos - at[seg]
    node = off <= length[seg] - q  # positions at which a whole symbol starts
    g = np.zeros(len(body), np.uint64)
    g[: len(body) - q + 1] = B.gram_hash(B.prefix(body), q)
    v = np.flatnonzero(node)
    number = np.full(len(body), -1, np.int64)
    number[v] = np.arange(len(v))
    sym = np.unique(g[v], return_inverse=True)[1] + 1
    head = off[v] < q  # first of its phase; its phase's end mark has the number of marks before it
    mark = np.empty(len(v), np.int64)
    mark[head] = len(v) + np.arange(head.sum())
    where = at[seg[v]] + off[v] % q
    mark = mark[number[where]]
    last = off[v] + q > length[seg[v]] - q
    following = np.concatenate((np.where(last, mark, 0), np.flatnonzero(head)))
    following[: len(v)][~last] = number[v[~last] + q]
    before = np.empty(len(following), np.int64)
    before[following] = np.arange(len(following))
    symbol = np.concatenate((sym, np.zeros(head.sum(), np.int64))).astype(np.int32)
    owner = np.concatenate((seg[v], seg[v][head]))
    shard = (at // shard_bytes)[owner]
    by = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[by])) + 1
    depth = span // q
    merged, lcp = merge_transforms(symbol, before, [shard_order(symbol, following, part, depth) for part in np.split(by, cut)], depth)
    group = np.cumsum(lcp < depth) - 1
    window = np.zeros(len(following), bool)
    window[: len(v)] = off[v] < size[seg[v]]
    live = window[merged]
    merged, group = merged[live], group[live]
    best = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
    r = rank[owner[merged]]
    np.minimum.at(best, group, r)
    out = np.zeros(len(body), bool)
    out[v[merged]] = r > best[group]
    return out[off < size[seg]]


_VERDICT = "block long, kind int, bucket int, home binary, idx binary, n binary, mask binary"
_VERDICT_TYPES = {"block": pa.int64(), "kind": pa.int32(), "bucket": pa.int32(), **dict.fromkeys(("home", "idx", "n", "mask"), pa.binary())}


def _resolve(batch_bytes: int):
    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        bucket, block = table["bucket"].to_pylist(), table["block"].to_pylist()
        rows = [(block[r], 2, bucket[r], b"", table["idx"][int(r)].as_py(), b"", b"") for r in np.flatnonzero(kind == 2)]
        pick = np.flatnonzero(kind == 0)
        if len(pick):
            t = table.take(pa.array(pick))
            row, h, c, doc, idx, size = _gather(t, h=np.uint64, c=np.uint64, doc=np.int64, idx=np.uint32, n=np.uint16)
            size = size.astype(np.int64)
            body = np.frombuffer(b"".join(t["body"].to_pylist()), np.uint8)
            length = size + SPAN - 1
            at = np.cumsum(length) - length
            order = np.lexsort((idx, doc, h))
            rank = np.empty(len(order), np.int64)
            rank[np.lexsort((idx, doc))] = np.arange(len(order))
            masks = [None] * len(order)
            hs, used, s = h[order], np.cumsum(length[order]), 0
            while s < len(order):  # whole k-grams, of about so many bytes
                e = max(s + 1, int(np.searchsorted(used, (used[s - 1] if s else 0) + batch_bytes, "right")))
                e = int(np.searchsorted(hs, hs[e - 1], "right"))
                some = np.sort(order[s:e])
                text = np.concatenate([body[at[x] : at[x] + length[x]] for x in some])
                for x, m in zip(some, np.split(repeats(text, size[some], rank[some]), np.cumsum(size[some])[:-1])):
                    masks[x] = m
                s = e
            for r, part in enumerate(np.split(np.arange(len(order)), np.searchsorted(row, np.arange(1, len(t))))):
                m = np.concatenate([masks[x] for x in part])
                if m.any():
                    rows.append((block[pick[r]], 0, bucket[pick[r]], b"", idx[part].tobytes(), size[part].astype(np.uint16).tobytes(), np.packbits(m).tobytes()))
        pick = np.flatnonzero(kind == 1)
        if len(pick):
            t = table.take(pa.array(pick))
            row, f1, f2, doc, home, idx, off = _gather(t, h=np.uint64, c=np.uint64, doc=np.int64, home=np.uint32, idx=np.uint32, n=np.uint16)
            order = np.lexsort((off, idx, home, doc, f2, f1))
            a, b = f1[order], f2[order]
            lead = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            # within a block and k-gram, equal windows of one doc_id come in order of their entries
            gone = np.sort(order[~lead])
            for r, e in enumerate(np.split(gone, np.searchsorted(row[gone], np.arange(1, len(t))))):
                if len(e):
                    rows.append((block[pick[r]], 1, -1, home[e].tobytes(), idx[e].tobytes(), off[e].tobytes(), b""))
        cols = list(zip(*rows)) or [[]] * len(_VERDICT_TYPES)
        return pa.table({n: pa.array(list(v), t) for (n, t), v in zip(_VERDICT_TYPES.items(), cols)})

    return run


def covered(x: Block, verdicts: pa.Table) -> np.ndarray:
    """Which bytes of the block go."""
    cover = np.zeros(len(x.buf) + 1, np.int32)

    def windows(s, e):
        np.add.at(cover, s, 1)
        np.add.at(cover, e - 1 + SPAN, -1)

    windows(x.start[x.again], x.end[x.again])
    for kind, bucket, home, idx, n, mask in zip(*(verdicts[c].to_pylist() for c in ("kind", "bucket", "home", "idx", "n", "mask"))):
        idx = np.frombuffer(idx, np.uint32)
        if kind == 1:
            s = x.start[x.entry[x.at[np.frombuffer(home, np.uint32)] + idx]] + np.frombuffer(n, np.uint16)
            windows(s, s + 1)
            continue
        e = x.entry[x.at[bucket] + idx]
        if kind == 2:
            windows(x.start[e], x.end[e])
        else:
            size = np.frombuffer(n, np.uint16).astype(np.int64)
            off = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            s = (np.repeat(x.start[e], size) + off)[np.unpackbits(np.frombuffer(mask, np.uint8), count=int(size.sum())).astype(bool)]
            windows(s, s + 1)
    np.cumsum(cover, out=cover)
    return cover[:-1] > 0


def _cut(id_col, text_col, block_col, buckets, columns, with_text):
    def run(docs: pa.Table, verdicts: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table({})
        x = Block(docs, id_col, text_col, buckets)
        gone = covered(x, verdicts)
        gap = np.concatenate((gone, [False]))
        run_start = gap.copy()
        run_start[1:] &= ~gap[:-1]
        inner = x.offs[:-1][x.offs[:-1] < len(gone)]
        run_start[inner] = gap[inner]
        c1, c2 = (np.concatenate(([0], np.cumsum(v, dtype=np.int32))) for v in (gap, run_start))
        kept = x.buf[~gone].tobytes()
        ends = x.offs - c1[x.offs]
        parts = [kept[i:j] for i, j in zip(ends, ends[1:])]
        out = {c: x.table[c] for c in columns}
        out["n_bytes"] = pa.array(np.diff(x.offs), pa.int64())
        out["n_removed"] = pa.array(c1[x.offs[1:]] - c1[x.offs[:-1]], pa.int64())
        out["n_spans"] = pa.array(c2[x.offs[1:]] - c2[x.offs[:-1]], pa.int64())
        out["kept_sha256"] = pa.array([hashlib.sha256(p).hexdigest() for p in parts])
        if with_text:
            out["kept_text"] = pa.array([p.decode("utf-8", "ignore") for p in parts])
        return pa.table(out)

    return run


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False, block_bytes: int = 4 << 20, bucket_bytes: int = 16 << 20, hot: int = 20_000, batch_bytes: int = 1 << 19) -> DataFrame:
    """Cut every byte covered by a 100-byte string that also starts earlier in the corpus.

    docs has doc_id (integer) and text (string, as UTF-8 bytes); null and empty texts have no bytes.
    Earlier: a smaller doc_id, or the same document and an earlier start; rows of one doc_id count in
    order of their texts, a null doc_id before all others. Overlaps count; strings are judged on the
    input; matches never cross documents. Returns the columns `keep` of docs, n_bytes, n_removed,
    n_spans (maximal removed runs), kept_sha256 and, with_text, kept_text, in which characters that a
    cut has split are left out. Columns in `keep` that are named like results are replaced.
    """
    spark = docs.sparkSession
    keep = tuple(c for c in docs.columns if c in keep)
    need = dict.fromkeys((*keep, "doc_id", "text"))
    if not with_text or "text" not in keep:
        keep = tuple(c for c in keep if c != "text")
    d = docs.select(*need)
    block_col = internal(d, "_block")
    n_bytes = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = width(spark)
    blocks, buckets = max(-(-n_bytes // block_bytes), 2 * n), max(-(-n_bytes // bucket_bytes), 2 * n)
    d = d.withColumn(block_col, F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).repartition(block_col)
    names = ("doc_id", "text", block_col, buckets)
    sent = d.groupBy(block_col).applyInArrow(_send(*names), "bucket int, block long, h binary, c binary, doc binary")
    replies = sent.groupBy("bucket").applyInArrow(_answer(hot), "bucket int, block long, gone binary, ask binary, deal binary")
    detail = d.groupBy(block_col).cogroup(replies.groupBy("block")).applyInArrow(_detail(*names), _DETAIL)
    verdicts = detail.groupBy("bucket").applyInArrow(_resolve(batch_bytes), _VERDICT)
    keep = tuple(c for c in keep if c.lower() not in MADE)
    kinds = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_bytes long, n_removed long, n_spans long, kept_sha256 string", *["kept_text string"] * with_text])
    return d.groupBy(block_col).cogroup(verdicts.groupBy("block")).applyInArrow(_cut(*names, keep, with_text), schema)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with the repeated bytes cut from text, and n_chars, where there is one, counted anew."""
    at = {c: internal(docs, f"_{k}") if c.lower() in MADE else c for k, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(c).alias(x) for c, x in at.items()))
    found = remove_repeats(plain, keep=tuple(x for c, x in at.items() if c != "text"), with_text=True, **options)
    text = F.col("kept_text")
    made = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in at else {})
    return found.select(*(made.get(c, F.col(x)).alias(c) for c, x in at.items()))
