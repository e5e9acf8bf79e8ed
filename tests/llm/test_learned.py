"""Operators that learn: held-out accuracy, and their parts against brute force."""

import itertools
import os
import random
import re

import numpy as np
import pytest

from docloom.llm import bytecode as B
from docloom.llm import langid_crf, license_scan, quality, toxicity

SF = os.path.join(os.path.dirname(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001").rstrip("/")), "sf0.1")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def ranked(scores, labels):
    """Probability that a random positive scores above a random negative."""
    order = np.argsort(np.argsort(scores)) + 1
    pos = labels == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_quality_on_held_out_documents(spark):
    got = quality.classify(table(spark, "documents"), table(spark, "labels")).join(table(spark, "labels"), "doc_id").where("held_out").collect()
    y, s = np.array([r.quality for r in got]), np.array([r.score for r in got])
    assert ranked(s, y) > 0.9
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted for r in got if r.quality == 1]) > 0.99
    assert np.mean([r.predicted for r in got if r.quality == 0]) < 0.08


def test_quality_of_one_class_or_none():
    assert quality.train([], [])[1] == 0
    assert quality.train(["a", "b"], [1, 1])[1] > 0


def test_toxicity_on_held_out_documents(spark):
    got = toxicity.classify(table(spark, "documents"), table(spark, "labels")).join(table(spark, "labels").withColumnRenamed("toxic", "y"), "doc_id").where("held_out").collect()
    y, p = np.array([r.y for r in got]), np.array([r.toxic for r in got])
    assert y.sum() > 50 and ranked(np.array([r.score for r in got]), y) > 0.9
    assert p[y == 1].mean() >= 0.9 and p[y == 0].mean() < 0.01


def test_later_models_of_a_chain_see_the_earlier_ones():
    rng = random.Random(1)
    texts, y = [], []
    for _ in range(400):
        a = rng.random() < 0.5
        texts.append(" ".join(["bad" if a else "good", *(f"w{rng.randrange(50)}" for _ in range(10))]))
        y.append((a, a))
    chain = toxicity.Chain(["first", "second"]).fit(texts, np.array(y, float))
    assert len(chain.models[0][1]) == 0 and len(chain.models[1][1]) == 1 and chain.models[1][1][0] > 0


def test_scores_equal_a_naive_application_of_the_model(spark):
    rng = random.Random(4)
    texts = [None, "", "a", "ß é 語", "The the the", " x\ty ", "\U0001f600 z", *(" ".join(rng.choice(("für", "wort", "Éa", "b", "b")) for _ in range(rng.randrange(1, 40))) for _ in range(30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weight, bias = np.random.default_rng(5).normal(0, 1, quality._SIZE * (2 + len(quality.GRAMS))).astype(np.float32), 0.25

    def h(x):  # one span on its own
        b = x.encode()
        return int(B.span_hash(B.prefix(np.frombuffer(b, np.uint8)), np.array([0]), np.array([len(b)]))[0] >> B.U(64 - quality.BITS))

    got = {r.doc_id: r.score for r in quality.score(docs, (weight, bias)).collect()}
    for d, t in enumerate(texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        groups = [[h(x) for x in w], [quality._SIZE + (i > 0 and x == w[i - 1]) for i, x in enumerate(w)]]
        groups += [[k * quality._SIZE + h(t[i : i + n]) for i in range(len(t) - n + 1)] for k, n in enumerate(quality.GRAMS, 2)]
        z = bias + sum(float(np.mean([weight[i] for i in g])) for g in groups if g)
        assert abs(got[d] - 1 / (1 + np.exp(-z))) < 1e-6, t


def test_toxicity_equals_a_naive_application_of_the_chain(spark):
    rng = random.Random(6)
    texts = [None, "", "...", "a", *(" ".join(rng.choice(("bad", "Worse!", "good", "übel", "w%d" % rng.randrange(9))) for _ in range(rng.randrange(1, 20))) for _ in range(60))]
    y = [[int("bad" in (t or "")), int("bad" in (t or "") or "Worse" in (t or ""))] for t in texts]
    labels = spark.createDataFrame([(i, *v) for i, v in enumerate(y)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chain = toxicity.fit(docs, labels, {"a": "quality = 1", "b": "toxic = 1"})
    got = {r.doc_id: (r.p_a, r.p_b) for r in toxicity.classify(docs, labels, {"a": "quality = 1", "b": "toxic = 1"}).collect()}

    def buckets(t):
        out = set()
        for w in re.findall(r"[a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")):
            b = w.encode()
            for x in [b, *(b[:k] for k in toxicity.STEMS if len(b) > k)]:
                out.add(int(B.span_hash(B.prefix(np.frombuffer(x, np.uint8)), np.array([0]), np.array([len(x)]))[0] >> B.U(64 - toxicity.BITS)))
        return sorted(out)

    for d, t in enumerate(texts):
        earlier, ids = [], buckets(t)
        for k, (w, v, b) in enumerate(chain.models):
            p = 1 / (1 + np.exp(-np.clip(sum(float(w[i]) for i in ids) + sum(o * c for o, c in zip(earlier, v)) + b, -40, 40)))
            assert abs(p - got[d][k]) < 1e-6
            q = min(max(p, 1e-4), 1 - 1e-4)
            earlier.append(np.log(q / (1 - q)) / 4)


def test_languages_equal_a_naive_application_of_the_field(spark):
    rng = random.Random(7)
    words = {"aa": ["alpha", "ärger", "ab"], "bb": ["beta", "été", "ba"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randrange(1, 8))), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    rows += [(900, "alpha beta été alpha", None), (901, "12 34", None), (902, None, None), (903, "語", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    f = langid_crf.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid_crf.classify(docs).collect()}

    def emission(w):
        ids = []
        for kind, spans in ((11, [w[:k] for k in langid_crf.AFFIXES if len(w) >= k]), (12, [w[-k:] for k in langid_crf.AFFIXES if len(w) >= k]), (13, [w]), (14, [w[i : i + k] for k in langid_crf.GRAMS for i in range(len(w) - k + 1)])):
            for x in spans:
                b = x.encode()
                ids.append(int(langid_crf._bucket(B.span_hash(B.prefix(np.frombuffer(b, np.uint8)), np.array([0]), np.array([len(b)])), kind)[0]))
        return f.weight[ids].astype(float).sum(0) / np.sqrt(len(ids))

    for d, t, _ in rows:
        w = re.findall(r"[a-z\x80-\U0010ffff]+", (t or "").lower())
        if not w:
            assert got[d] == ("und", 0.0)
            continue
        e, total = np.array([emission(x) for x in w]), np.zeros((len(w), len(f.labels)))
        for path in itertools.product(range(len(f.labels)), repeat=len(w)):
            p = np.exp(sum(e[i, y] for i, y in enumerate(path)) + sum(f.move[u, v] for u, v in zip(path, path[1:])))
            for i, y in enumerate(path):
                total[i, y] += p
        share = (total / total.sum(1, keepdims=True)).mean(0)
        assert got[d][0] == f.labels[int(share.argmax())] and abs(got[d][1] - share.max()) < 1e-5


def test_languages_of_held_out_documents(spark):
    docs = table(spark, "documents")
    got = langid_crf.classify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


@pytest.fixture(scope="module")
def field():
    rng = np.random.default_rng(2)
    f = langid_crf.Field(["a", "b", "c"])
    f.move = rng.normal(0, 1, (3, 3))
    return f


def test_forward_backward_equals_enumeration(field):
    rng = np.random.default_rng(3)
    emit = rng.normal(0, 1, (11, 3))
    first = np.zeros(11, bool)
    first[[0, 1, 5]] = True
    post, pairs = field.marginals(emit, first)
    want, moves = np.zeros((11, 3)), np.zeros((3, 3))
    for a, b in ((0, 1), (1, 5), (5, 11)):
        paths = list(itertools.product(range(3), repeat=b - a))
        p = np.array([np.exp(sum(emit[a + i, y] for i, y in enumerate(path)) + sum(field.move[u, v] for u, v in zip(path, path[1:]))) for path in paths])
        p /= p.sum()
        for q, path in zip(p, paths):
            for i, y in enumerate(path):
                want[a + i, y] += q
            for u, v in zip(path, path[1:]):
                moves[u, v] += q
    assert np.allclose(post, want) and np.allclose(pairs, moves)


def test_code_switched_text_goes_to_the_larger_part(spark):
    docs = table(spark, "documents")
    f = langid_crf.fit(docs)
    by = {r.lang: r.text for r in docs.where("length(text) > 1500 and lang is not null").dropDuplicates(["lang"]).collect()}
    import pyarrow as pa

    for a, b in itertools.permutations(sorted(by), 2):
        wa, wb = by[a].split()[:150], by[b].split()[:50]
        buf, offs = B.flat(pa.array([" ".join(wa + wb), " ".join(wb + wa)]))
        best, share = langid_crf.identify(f, buf, offs)
        assert [f.labels[k] for k in best] == [a, a] and (share < 0.95).all()


# ---- licences


def variants():
    mit = license_scan.TEXTS["MIT"]
    return [
        (1, mit, "MIT"),
        (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(".", " ;"), "MIT"),
        (3, mit.replace("Software", "Softwares", 1), None),
        (4, mit + " extra", None),
        (5, license_scan.TEXTS["Zlib"].replace("acknowledgment", "acknowledgement"), "Zlib"),
        (6, license_scan.TEXTS["ISC"].replace("\n", "  \n\t"), "ISC"),
        (7, "© 1999 X\n" + license_scan.TEXTS["BSD-3-Clause"].replace("copyright holder", "copyright owner"), "BSD-3-Clause"),
        (8, None, None),
        (9, "", None),
        (10, "a licence\nReleased under the MIT Licence.\nLicensed under CC BY 4.0", None),
    ]


def test_entire_licence_texts(spark):
    rows = variants()
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")).collect()}
    assert {d: got[d].license_id for d, _, _ in rows} == {d: x for d, _, x in rows}
    assert got[10].notice_ids == "CC-BY-4.0,MIT"


def test_every_notice_passes_the_word_filter():
    for n in (x for v in license_scan.NOTICES.values() for x in v):
        assert re.search(license_scan.NOTICE_WORDS, n.lower())


def test_licences_equal_sql(spark, sf_dir, tmp_path):
    import duckdb

    rows = [x[:2] for x in variants()] + [(1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(5000 + i, t) for i, t in enumerate([*license_scan.TEXTS.values(), "...", "Do what you want with this file."])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    want = con.execute(license_scan.oracle())
    columns = [c[0] for c in want.description]
    got = license_scan.scan(docs).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
    assert sum(r.license_id is not None for r in got) >= 14 and sum(r.notice_ids != "" for r in got) > 1


def test_further_licences_can_be_given(spark):
    text = "My own permission to do as you like."
    known = spark.createDataFrame([("Own", text)], "license_id string, text string").selectExpr(f"{license_scan.digest_sql('text')} AS digest", "license_id")
    got = license_scan.scan(spark.createDataFrame([(1, text.upper())], "doc_id long, text string"), known).collect()
    assert got[0].license_id == "Own"


def test_further_licences_need_none_of_the_english_words(spark):
    text = "Jeder darf dieses Werk frei nutzen und weitergeben."
    known = spark.createDataFrame([("Frei", text)], "license_id string, text string").selectExpr(f"{license_scan.digest_sql('text')} AS digest", "license_id")
    rows = [(1, text.upper()), (2, text + " Nicht!"), (3, None), (4, ""), (5, "...")]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()}
    assert {d: r.license_id for d, r in got.items()} == {1: "Frei", 2: None, 3: None, 4: None, 5: None}
    assert [got[d].digest for d in (3, 4, 5)] == [None] * 3
