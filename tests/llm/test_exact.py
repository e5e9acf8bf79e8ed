"""Operators with one right answer, against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from docloom.llm import decontam, lm_bloom, minhash, packing, suffix_dedup, topk_bsi

SCHEMA = "doc_id long, text string"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary):x}{'aeiou'[rng.randrange(5)]}" for _ in range(n))


# ---- repeated bytes


def brute_repeats(rows, span=100):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            w = b[i : i + span]
            if w in seen:
                gone[i : i + span] = b"\1" * span
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[doc] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def repeat_rows():
    rng = random.Random(1)
    passages = [prose(rng, 40) for _ in range(5)]
    rows = [(-3, "früh " * 60), (0, None), (1, ""), (2, "x" * 99), (3, "x" * 100), (4, "x" * 101), (5, "x" * 350), (6, "ab" * 400), (7, "ba" * 90), (8, "日本語テキスト" * 40), (9, "語テキスト日本" * 30)]
    for i in range(10, 90):
        parts = [prose(rng, rng.randrange(60)) for _ in range(3)]
        if i % 2:
            parts.insert(rng.randrange(3), rng.choice(passages))
        if i % 7 == 0:
            parts.insert(rng.randrange(3), passages[0][rng.randrange(30) :])
        rows.append((i, " ".join(parts)))
    rows += [(200 + k, rows[20][1]) for k in range(6)] + [(300 + k, rows[30][1][k:] + "!") for k in range(6)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"hot": 2, "block_bytes": 3000, "batch_bytes": 2000}, {"hot": 10**9, "block_bytes": 20000, "batch_bytes": 500}])
def test_repeats_equal_brute_force(spark, options):
    rows = repeat_rows()
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), **options).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_repeats(rows)
    assert len(got) == len(rows)


def test_repeats_in_rows_of_one_doc_id(spark):
    rng = random.Random(2)
    p = prose(rng, 50)
    rows = [(1, p + " a"), (1, p + " b"), (1, p + " a"), (None, p)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4
    full = [r for r in got if r.n_removed == 0]
    assert len(full) == 1 and full[0].doc_id is None  # a null doc_id comes before all others
    # rows of one doc_id come in order of their texts: of the two ending in " a" the second repeats the first throughout, of " b" only the last byte is new
    assert sorted((r.n_bytes - r.n_removed, r.n_spans) for r in got if r.doc_id == 1) == [(0, 1), (1, 1), (2, 1)]


def test_kept_text_is_what_the_digest_says(spark):
    rows = repeat_rows()
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_text=True).collect()
    ascii_only = [r for r in got if hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256]
    assert len(ascii_only) >= len(rows) - 4


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_merged_transforms_are_sorted_with_common_prefixes(shards):
    rng = np.random.default_rng(shards)
    n, depth = 300, 6
    symbol = rng.integers(0, 3, n).astype(np.int32)
    following = np.roll(np.arange(n), -1)
    before = np.empty(n, np.int64)
    before[following] = np.arange(n)
    parts = np.array_split(rng.permutation(n), shards)
    cut = [np.arange(a * n // shards, (a + 1) * n // shards) for a in range(shards)]
    del parts
    text = [tuple(symbol[(i + k) % n] for k in range(depth)) for i in range(n)]
    # a shard's own order only looks within the shard; each is closed to a cycle of its own
    symbol2, following2, before2, want = symbol, following.copy(), before.copy(), {}
    for c in cut:
        following2[c] = np.roll(c, -1)
        before2[c] = np.roll(c, 1)
        for i, node in enumerate(c):
            want[node] = tuple(symbol2[c[(i + k) % len(c)]] for k in range(depth))
    merged, lcp = suffix_dedup.merge_transforms(symbol2, before2, [suffix_dedup.shard_order(symbol2, following2, c, depth) for c in cut], depth)
    keys = [want[m] for m in merged]
    assert keys == sorted(keys) and sorted(merged) == list(range(n))
    for a, b, k in zip(keys, keys[1:], lcp[1:]):
        assert k == next((i for i in range(depth) if a[i] != b[i]), depth)
    assert len(text) == n


def test_symbols_of_any_length_give_the_same_repeats():
    rng = random.Random(15)
    passages = [prose(rng, 30).encode() for _ in range(3)]
    parts = [b"".join(rng.choice(passages)[rng.randrange(40) :] for _ in range(2))[: rng.randrange(110, 250)] for _ in range(40)] + [b"ab" * 80, b"ab" * 70]
    size = np.array([len(x) - 99 for x in parts])
    rank = np.array(rng.sample(range(len(parts)), len(parts)))
    first, want = {}, []
    for i, x in enumerate(parts):
        for w in {x[j : j + 100] for j in range(size[i])}:
            first[w] = min(first.get(w, rank[i]), rank[i])
    for i, x in enumerate(parts):
        want += [rank[i] > first[x[j : j + 100]] for j in range(size[i])]
    body = np.frombuffer(b"".join(parts), np.uint8)
    for q in (10, 20, 25, 50):
        assert suffix_dedup.repeats(body, size, rank, q=q, shard_bytes=1000).tolist() == want


# ---- near duplicates


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_components(rows, k, percent=80):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)}


def near_rows():
    rng = random.Random(3)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one  TWO"), (5, "one two three"), (6, "É é"), (7, "é É")]
    n = 10
    for _ in range(12):
        base = prose(rng, rng.randrange(4, 120)).split()
        for _ in range(rng.randrange(1, 14)):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(999)}"
            rows.append((n, " ".join(w)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shingle, block", [(4, 1024), (5, 1024), (4, 3)])
def test_near_duplicates_equal_brute_force(spark, shingle, block):
    rows = near_rows()
    want = brute_components(rows, shingle)
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=shingle, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_large_cluster_with_drifting_copies_equals_brute_force(spark):
    rng = random.Random(8)
    base = prose(rng, 90).split()
    rows, w = [], list(base)
    for n in range(60):  # near copies of one text, and a chain that drifts away from it
        c = list(base)
        for _ in range(rng.randrange(6)):
            c[rng.randrange(len(c))] = f"e{rng.randrange(99)}"
        w[rng.randrange(len(w))] = f"d{n}"
        rows += [(2 * n, " ".join(c)), (2 * n + 1, " ".join(w))]
    want = brute_components(rows, 4)
    assert 1 < len({c for _, c in want.values()})
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=4, block=7, broadcast_rows=0).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_duplicates_equal_brute_force_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = minhash.near_duplicates(docs, shingle=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 4)


def test_dropping_near_duplicates_keeps_one_of_each_component(spark):
    rows = near_rows()
    want = brute_components(rows, 5)
    kept = minhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in kept} == {d for d, (_, c) in want.items() if c == d}


def test_rows_of_one_doc_id_go_by_their_own_texts(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six"
    rows = [(1, a), (5, a), (5, b), (None, b), (None, "nothing else is like this text at all"), (7, None), (7, "")]
    got = sorted(((r.doc_id, r.text) for r in minhash.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([(1, a), (5, b), (None, "nothing else is like this text at all"), (7, None), (7, "")], key=repr)


def test_pruning_bounds_follow_the_posterior():
    least = minhash.least_matches(0.8, 1e-6, 96)
    assert list(least) == sorted(least) and 0 < least[-1] < 0.8 * 96
    # of pairs at the threshold itself, next to none are given up
    rng = np.random.default_rng(0)
    hits = rng.random((20000, 96)) < 0.8
    counts = hits.reshape(20000, -1, minhash.BATCH).sum(2).cumsum(1)
    assert ((counts < np.array(least)).any(1)).mean() < 1e-3


def test_pairs_at_the_threshold_are_pruned_with_probability_miss_at_most():
    for threshold, miss in ((0.8, 1e-6), (0.5, 1e-4)):
        step = np.array([math.comb(minhash.BATCH, i) * threshold**i * (1 - threshold) ** (minhash.BATCH - i) for i in range(minhash.BATCH + 1)])
        alive, lost = np.ones(1), 0.0
        for least in minhash.least_matches(threshold, miss, 96):
            alive = np.convolve(alive, step)
            lost += alive[:least].sum()
            alive[:least] = 0
        assert 0 < lost <= miss


# ---- packing


def test_buckets_are_optimal():
    rng = random.Random(4)
    for _ in range(60):
        x = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        n = [rng.randrange(1, 9) for _ in x]
        k = rng.randrange(1, 5)
        waste = lambda bounds: sum(c * (min(b for b in bounds if b >= v) - v) for v, c in zip(x, n))
        got = packing.optimal_buckets(x, n, k)
        best = min(waste((*c, x[-1])) for r in range(min(k, len(x))) for c in itertools.combinations(x[:-1], r))
        assert waste(got) == best and len(got) <= k and got == sorted(set(got))


def test_packing_is_whole(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([1, 5, 5, 5, 40, 300]))) for i in range(300)] + [(1000, None), (1001, ""), (1002, "w " * 30000), (7, "again")]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), buckets=4, budget=1000, rows_per_chunk=20).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((d, len((t or "").split())) for d, t in rows)
    bounds = {r.bucket_length for r in got}
    assert len(bounds) <= 4
    for b in bounds:
        mine = [r for r in got if r.bucket_length == b]
        per = max(1, 1000 // b)
        assert sorted((r.batch, r.slot) for r in mine) == [(i // per, i % per) for i in range(len(mine))]
        assert all(r.padding == b - r.n_tokens >= 0 for r in mine)


def test_padding_of_documents_is_minimal(spark, sf_dir):
    got = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), buckets=3).collect()
    lengths = Counter(max(1, r.n_tokens) for r in got)
    x = np.array(sorted(lengths))
    n = np.array([lengths[v] for v in x])
    c, total = np.cumsum(n), np.cumsum(n * x)
    best = None
    for i in range(len(x)):  # first bound x[i], second x[j], last the longest
        for j in range(i, len(x)):
            waste = x[i] * c[i] + x[j] * (c[j] - c[i]) + x[-1] * (c[-1] - c[j]) - total[-1]
            best = waste if best is None else min(best, waste)
    assert len(x) > 100 and sum(r.padding for r in got) - sum(r.n_tokens == 0 for r in got) == best


def test_padding_of_long_documents_is_minimal(spark):
    lengths = [4097, 4100, 4100, 4159, 5001, 5003, 9001, 9100, 20020]
    got = packing.pack(spark.createDataFrame([(i, "w " * n) for i, n in enumerate(lengths)], SCHEMA), buckets=3).collect()
    x = sorted(set(lengths))
    best = min(sum(min(b for b in (*p, x[-1]) if b >= v) - v for v in lengths) for p in itertools.combinations(x[:-1], 2))
    assert sum(r.padding for r in got) == best and max(r.bucket_length for r in got) == 20020


# ---- language model


def lm_tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0d]+", low), None]


@pytest.mark.parametrize("options", [{}, {"filter_bytes": 300, "block_bytes": 2000}])
def test_base_score_equals_brute_force(spark, options):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(80), 60)) for i in range(120)] + [(900, None), (901, ""), (902, "ÀÉ aé É"), (903, "Word word WORD\tword")]
    train = [t for d, t in rows if d % 3]
    c = Counter(x for t in train for x in lm_tokens(t))
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in lm_bloom.score(spark.createDataFrame(rows, SCHEMA), "doc_id % 3 <> 0", **options).collect()}
    assert len(got) == len(rows)
    pairs = Counter()
    for t in train:
        x = lm_tokens(t)
        pairs.update(zip(["<s>", *x[:-1]], x))
    starts = Counter({"<s>": len(train)})
    exact = 0
    for d, t in rows:
        x, r = lm_tokens(t), got[d]
        base = sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d % 3 == 0, len(x), sum(c[w] > 0 for w in x), n)
        assert abs(r.base_score - base) < 1e-6
        full = 0.0
        for u, w in zip(["<s>", *x[:-1]], x):
            p1, cu = (c[w] + 0.1) / (n + 0.1 * (v + 1)), starts["<s>"] if u == "<s>" else c[u]
            k = pairs[u, w]
            quantised = 2 ** int(np.log2(k)) if k else 0
            full += np.log10((quantised + 64 * p1) / (cu + 64))
        assert -1e-6 < r.score - full < 4  # a false positive of the filter raises a bigram now and then
        exact += abs(r.score - full) < 1e-6
    assert exact > 0.6 * len(rows)


def test_the_filter_forgets_no_count():
    rng = np.random.default_rng(7)
    key = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) & np.uint64((1 << 48) - 1)
    count = rng.integers(1, 3000, len(key))
    bits, raw = lm_bloom.fill_slice(key, count)
    f = lm_bloom.Filter([(0, bits, raw)], 1)
    got = f.counts(key, np.zeros(len(key), np.int64))
    exact = np.exp2(np.log2(count).astype(int))
    assert (got >= exact).all() and (got == exact).mean() > 0.98
    other = rng.integers(0, 1 << 63, 20000, dtype=np.uint64)
    assert (f.counts(other, np.zeros(len(other), np.int64)) > 0).mean() < 0.02


def test_bigrams_seen_once_are_in_the_filter(spark):
    rng = np.random.default_rng(8)
    key = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) & np.uint64((1 << 48) - 1)
    count = np.repeat([1, 2, 3, 4], 1000)
    bits, raw = lm_bloom.fill_slice(key, count)
    got = lm_bloom.Filter([(0, bits, raw)], 1).counts(key, np.zeros(len(key), np.int64))
    assert (got >= 2.0 ** np.log2(count).astype(int)).all() and (got == np.repeat([1.0, 2.0, 2.0, 4.0], 1000)).mean() > 0.98

    rng = random.Random(12)
    words = [f"v{i}" for i in range(200)]
    rows = [(i, f"{w} {x}") for i, (w, x) in enumerate(zip(words, rng.sample(words, 200)))]
    rows += [(1000 + i, t) for i, t in rows] + [(2000 + i, f"{w} {w}") for i, w in enumerate(words)]
    got = {r.doc_id: r for r in lm_bloom.score(spark.createDataFrame(rows, SCHEMA), "doc_id < 1000").collect()}
    c = Counter(x for i, t in rows if i < 1000 for x in lm_tokens(t))
    pairs = Counter(p for i, t in rows if i < 1000 for p in zip(["<s>", *lm_tokens(t)[:-1]], lm_tokens(t)))
    n, v = sum(c.values()), len(c)
    exact = 0
    for d, t in rows:
        x, want = lm_tokens(t), 0.0
        for u, w in zip(["<s>", *x[:-1]], x):
            cu, k = 200 if u == "<s>" else c[u], pairs[u, w]
            estimate = 2 ** int(np.log2(k)) if k else 0
            want += np.log10((estimate + 64 * (c[w] + 0.1) / (n + 0.1 * (v + 1))) / (cu + 64))
        assert got[d].score - want > -1e-6
        exact += abs(got[d].score - want) < 1e-6
    assert exact > 0.9 * len(rows)


def test_rows_of_one_doc_id_with_words_in_another_order_keep_their_scores(spark):
    rows = [(i, "alpha beta") for i in range(50)] + [(d, t) for d in (900, None) for t in ("alpha beta", "beta alpha", "beta alpha")]
    docs = spark.createDataFrame(rows, SCHEMA)
    one, several = (sorted(((r.doc_id or -1, r.score) for r in lm_bloom.score(docs, "doc_id < 900", **options).collect())) for options in ({}, {"filter_bytes": 1}))
    assert len(one) == len(several) == len(rows)
    assert [d for d, _ in one] == [d for d, _ in several] and np.allclose([x for _, x in one], [x for _, x in several], atol=1e-9)


def test_probabilities_of_a_context_sum_to_one_at_most(spark):
    rng = random.Random(14)
    words = [f"v{i}" for i in range(30)]
    train = [(i, " ".join(rng.choice(words) for _ in range(40))) for i in range(60)]
    pairs = [(1000 + i, f"{u} {v}") for i, (u, v) in enumerate(itertools.product(words, words))] + [(5000 + i, u) for i, u in enumerate(words)]
    got = {r.doc_id: r.score for r in lm_bloom.score(spark.createDataFrame(train + pairs, SCHEMA), "doc_id < 1000").collect()}
    # P(v | u) P(end | v) over P(u | start) ... is told apart by scoring u alone: P(u | start) P(end | u)
    c = Counter(x for _, t in train for x in lm_tokens(t))
    n, v = sum(c.values()), len(c)
    ends = Counter(lm_tokens(t)[-2] for _, t in train)
    p1 = lambda x: (c[x] + 0.1) / (n + 0.1 * (v + 1))
    end = {u: (2 ** int(np.log2(ends[u])) if ends[u] else 0) for u in words}
    p_end = {u: (end[u] + 64 * p1(None)) / (c[u] + 64) for u in words}
    alone = {u: 10 ** got[5000 + i] / p_end[u] for i, u in enumerate(words)}  # P(u | start)
    for a, u in enumerate(words):
        total = p_end[u] + sum(10 ** got[1000 + a * 30 + b] / alone[u] / p_end[w] for b, w in enumerate(words))
        assert 0.5 < total < 1.05  # a false positive here and there


# ---- benchmark passages


def decontam_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def grams(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute_matches(docs, items):
    """All windows of each document against each item, their common shingles counted as the window moves."""
    out = set()
    for d, t in docs:
        w = decontam_words(t)
        have = {k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] for k in range(1, decontam.SIZE + 1)}
        every = {k: set(v) for k, v in have.items()}
        for i, x in items:
            iw = decontam_words(x)
            k = min(decontam.SIZE, len(iw))
            want = grams(iw, k) if iw else {}
            if not want or len(w) < k or not every[k] & want.keys():
                continue
            n = min(len(iw), len(w)) - k + 1
            got, both = Counter(), 0
            for e, g in enumerate(have[k]):
                got[g] += 1
                both += got[g] <= want[g]
                if e >= n:
                    old = have[k][e - n]
                    both -= got[old] <= want[old]
                    got[old] -= 1
                if e >= n - 1 and both * 100 >= 80 * (n + sum(want.values()) - both):
                    out.add((d, i))
                    break
    return out


def contaminated_docs():
    rng = random.Random(8)
    items = [(i, prose(rng, n, 3000)) for i, n in enumerate((3, 5, 8, 20, 40, 40, 60))] + [(50, None), (51, ""), (52, "a a a a a a a a a b"), (53, items_repeat())]
    docs = [(0, None), (1, ""), (2, "..."), (3, "A, a a; a a a A a a b"), (4, items_repeat() + " x")]
    for d in range(5, 90):
        w = prose(rng, rng.randrange(2, 90), 3000).split()
        if d % 2:
            x = decontam_words(rng.choice(items[:7])[1])
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                x[rng.randrange(len(x))] = "changed"
            at = rng.randrange(len(w))
            w[at:at] = x
        docs.append((d, rng.choice((" ", ", ")).join(w).title()))
    return docs, items


def items_repeat():
    return "la la di da " * 9


def test_contamination_equals_brute_force(spark):
    docs, items = contaminated_docs()
    got = decontam.contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.doc_id, i) for r in got for i in r.item_ids}
    want = brute_matches(docs, items)
    assert len(got) == len(docs) and len(want) > 15
    assert found == want
    assert all(r.contaminated == (r.n_items > 0) == (r.similarity is not None) for r in got)


def test_contamination_without_broadcast(spark):
    docs, items = contaminated_docs()
    d, i = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    a, b = (sorted((r.doc_id, tuple(r.item_ids)) for r in decontam.contamination(d, i, broadcast_rows=n).collect()) for n in (10**6, 0))
    assert a == b


def test_hamming_blocks_lose_no_pair_within_the_radius(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), decontam.RADIUS):
            y ^= 1 << b
        rows.append(tuple(v - (1 << 64) if v >> 63 else v for v in (x, y)))
    df = spark.createDataFrame(rows, "x long, y long")
    from pyspark.sql import functions as F

    both = df.select(F.size(F.array_intersect(decontam.hamming_blocks(F.col("x")), decontam.near_blocks(F.col("y")))).alias("n"))
    assert both.where("n = 0").count() == 0
    assert df.select(F.size(decontam.near_blocks(F.col("x")))).first()[0] == 8 * 37


def test_windows_at_the_threshold_are_found_in_every_position(spark):
    rng = random.Random(13)
    items = [(i, prose(rng, n, 5000)) for i, n in enumerate(list(range(14, 60)) * 3)]
    docs, want = [], set()
    for d, (i, x) in enumerate(items):
        w = x.split()
        n = len(w) - 4
        spare = n - -(-80 * 2 * n // 180)  # so many shingles may differ
        if d % 3 == 0 and spare >= 5:
            w[rng.randrange(5, len(w) - 5)] = "changed"
        elif d % 3 == 1 and spare:
            w[: rng.randrange(1, spare + 1)] = ["changed"]
        a, b = prose(rng, rng.choice((0, 1, 30)), 5000), prose(rng, rng.choice((0, 1, 30)), 5000)
        docs.append((d, " ".join([a, *w, b])))
    want = brute_matches(docs, items)
    got = decontam.contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, i) for r in got for i in r.item_ids} == want and len(want) > 100


def test_simhash_counts_bits(spark):
    rng = random.Random(10)
    rows = [([rng.getrandbits(64) - (1 << 63) for _ in range(n)],) for n in (1, 2, 3, 10, 101)]
    got = [r[0] for r in spark.createDataFrame(rows, "h array<long>").selectExpr("h").select(decontam.simhash("h")).collect()]
    for (h,), fp in zip(rows, got):
        want = sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))
        assert fp & (1 << 64) - 1 == want


# ---- exact top-k


@pytest.mark.parametrize("options", [{}, {"block_rows": 37, "group_queries": 3}])
def test_top_k_equals_brute_force(spark, options):
    rng = np.random.default_rng(11)
    x = rng.normal(0, 0.3, (300, 9)).round(2)
    x[100:140] = x[0]  # ties
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)] + [(500, None), (550, [0.1, None]), (600, [float("nan")] * 9), (650, [float("inf")] * 9), (700, []), (None, [0.5] * 9), (750, [1.0])]
    got = topk_bsi.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id % 50 = 0", **options).collect()
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(int)) for i, v in rows if i is not None and v is not None and i not in (550, 600, 650)]
    good = [(i, np.pad(v, (0, 9 - len(v)))) for i, v in good]
    want = []
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-int(v @ w), i) for i, w in good if i != q)[:5]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_huge_components_count_as_the_bound(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 0.0]), (2, [3.0, 0.0]), (3, [2.0, 1e18])]
    bound = math.isqrt((1 << 63) // 2) - 1
    bound = math.floor(float(bound))
    x = {i: [max(-bound, min(bound, math.floor(256 * c))) for c in v] for i, v in rows}
    got = topk_bsi.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 50 = 0").collect()
    want = sorted(((-sum(a * b for a, b in zip(x[0], x[i])), i) for i in (1, 2, 3)))
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]


def test_fewer_candidates_than_k(spark):
    got = topk_bsi.top_k(spark.createDataFrame([(0, [1.0]), (50, [-1.0]), (3, [0.5])], "vec_id long, embedding array<float>"), "vec_id % 50 = 0").collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 3, 32768), (0, 2, 50, -65536), (50, 1, 3, -32768), (50, 2, 0, -65536)]
