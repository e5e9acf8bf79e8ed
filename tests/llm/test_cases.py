"""Nulls, empty and very long texts, repeated rows, empty tables and clashing names, for every operator and stage."""

import random

import pytest

import __spark_entry__ as entry
from docloom.llm import decontam, langid_crf, license_scan, lm_bloom, minhash, packing, quality, suffix_dedup, topk_bsi, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like those the operators make or use.
CLASHES = "score kept component_id node keys label cluster n_bytes n_removed _block _text _quality _gone block_col held_out digest license_id w h number value start n_tokens length chunk _id _y".split()


def rows():
    rng = random.Random(1)
    prose = lambda n: " ".join(f"word{rng.randrange(300)}" for _ in range(n))
    long = prose(60_000)
    texts = [None, "", " ", "\x00\x01", "a", "A a a", "ß é 語", "😀" * 300, long, long, long + " end", "x" * 200_000, "\n" * 1000]
    out = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    out += [(3, "\x00\x01", "en", "s", None), (None, "null id", None, None, None), (None, None, None, None, None), (None, "null id", None, None, None)]
    return out + [(100 + i, prose(rng.randrange(100)), rng.choice(("en", "fr", None)), "hot", 5) for i in range(60)]


@pytest.fixture(scope="module")
def tables(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows(), DOCS).withColumns({c: F.lit(None).cast("string") if k % 2 else F.lit(k) for k, c in enumerate(CLASHES)})
    docs = docs.cache()
    labels = spark.createDataFrame([(d, d % 2, d % 3 // 2) for d in range(100, 160)] + [(None, 1, 1), (8, None, None), (1, 1, None), (101, 0, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(0, None), (1, ""), (2, "word1 word2 word3 word4 word5 word6"), (2, "word1 word2 word3 word4 word5 word6"), (None, "null item of six words here")], "item_id long, text string")
    return docs, labels, bench


def apply(name, docs, labels, bench):
    return {
        "repeats": lambda: suffix_dedup.remove_repeats(docs),
        "packing": lambda: packing.pack(docs),
        "near": lambda: minhash.near_duplicates(docs),
        "quality": lambda: quality.classify(docs, labels),
        "license": lambda: license_scan.scan(docs),
        "toxicity": lambda: toxicity.classify(docs, labels),
        "lm": lambda: lm_bloom.score(docs, "crc32(cast(doc_id as string)) % 10 <> 0"),
        "decontam": lambda: decontam.contamination(docs, bench),
        "language": lambda: langid_crf.classify(docs),
    }[name]()


NAMES = ["repeats", "packing", "near", "quality", "license", "toxicity", "lm", "decontam", "language"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(spark, tables, name):
    got = apply(name, *tables)
    ids = sorted((r.doc_id for r in got.collect()), key=lambda x: (x is None, x))
    assert ids == sorted((r[0] for r in rows()), key=lambda x: (x is None, x))
    assert len(set(got.columns)) == len(got.columns)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, tables, name):
    docs, labels, bench = (t.limit(0) for t in tables)
    full = apply(name, *tables).schema
    got = apply(name, docs, labels, bench)
    assert got.collect() == [] and [f.dataType for f in got.schema] == [f.dataType for f in full]


@pytest.mark.parametrize("name", ["quality", "toxicity", "decontam"])
def test_empty_side_tables(spark, tables, name):
    docs, labels, bench = tables
    assert apply(name, docs, labels.limit(0), bench.limit(0)).count() == len(rows())


def test_stages_keep_the_columns(spark, tables):
    docs, labels, bench = tables
    for got in (quality.keep_good(docs, labels, threshold=0.0), minhash.drop_near_duplicates(docs), suffix_dedup.without_repeats(docs), decontam.drop_contaminated(docs, bench)):
        assert got.columns == docs.columns
        assert [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
        assert 0 < got.count() <= len(rows())


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk_bsi.top_k(empty, "vec_id % 50 = 0").collect() == []
    nulls = spark.createDataFrame([(0, None), (None, None)], "vec_id long, embedding array<float>")
    assert topk_bsi.top_k(nulls, "vec_id % 50 = 0").collect() == []
    twice = spark.createDataFrame([(0, [1.0], 1), (0, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1)], "vec_id long, embedding array<float>, score int")
    assert {r.vec_id for r in topk_bsi.top_k(twice, "vec_id = 0").collect()} == {1}


def test_registered_once_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
