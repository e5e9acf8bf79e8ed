"""The corpus pipeline: every stage against a brute-force version on what the stage before kept."""

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm import quality

from .test_exact import brute_components, brute_matches, brute_repeats


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        kept.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()]))
        if name != "pack":
            assert out.columns == columns
        docs = out
    by = {n: (before, after) for n, before, after in kept}
    assert list(by) == ["quality", "near_duplicates", "repeats", "decontaminate", "pack"]

    before, after = by["quality"]
    model = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality.score(spark.read.parquet(f"{sf_dir}/documents.parquet"), model).where("score >= 0.3").collect()}
    assert {r["doc_id"] for r in after} == good and len(good) < len(before)

    before, after = by["near_duplicates"]
    want = brute_components([(r["doc_id"], r["text"]) for r in before], 5)
    assert {r["doc_id"] for r in after} == {d for d, (_, c) in want.items() if d == c}

    before, after = by["repeats"]
    want = brute_repeats([(r["doc_id"], r["text"]) for r in before])
    whole = 0
    for r in after:
        whole += hashlib.sha256((r["text"] or "").encode()).hexdigest() == want[r["doc_id"]][3]
        assert r["n_chars"] == len(r["text"] or "")
    assert len(after) == len(before) and whole >= 0.98 * len(after)  # but where a cut splits a character

    before, after = by["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_matches([(r["doc_id"], r["text"]) for r in before], items)}
    assert leaks == {r["doc_id"] for r in before} - {r["doc_id"] for r in after}

    before, after = by["pack"]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)
    assert {r["doc_id"]: r["n_tokens"] for r in after} == {r["doc_id"]: len((r["text"] or "").split()) for r in before}


def test_run_is_the_stages_in_order(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert "batch" in got.columns and 0 < got.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows, rows of one doc_id, clashing columns, no rows, no labels, no benchmark."""
    long = " ".join(f"word{i % 977}" for i in range(40_000))
    rows = [(None, None, None), (None, "null id and some words", "x"), (1, None, None), (1, "", None), (1, "", None), (2, long, "x"), (3, long, "x"), (3, "other words than before in here", "x"), (4, "\x00 é 語", None), (5, "z", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for c in ("source", "n_chars", "score", "kept_text", "n_removed", "_gone_doc", "_quality", "w", "batch"):
        docs = docs.withColumn(c, F.lit(None).cast("long" if c == "n_chars" else "string"))
    labels = spark.createDataFrame([(2, 1, 0), (3, 1, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(0, None), (1, ""), (2, "benchmark words that no document has at all")], "item_id long, text string")
    for k, (n, some) in enumerate(((len(rows), (docs, labels, bench)), (0, (docs.limit(0), labels, bench)), (len(rows), (docs, labels.limit(0), bench.limit(0))))):
        d = str(tmp_path / str(k))
        for name, table in zip(("documents", "labels", "benchmark"), some):
            table.write.parquet(f"{d}/{name}.parquet")
        at = spark.read.parquet(f"{d}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, at, d)
            assert out.dtypes == docs.dtypes, name
            out.write.parquet(f"{d}/{name}")
            at = spark.read.parquet(f"{d}/{name}")
            if name == "near_duplicates":
                # of the long text one copy stays; rows without words are no duplicates
                assert at.count() == max(0, n - 1)
        got = corpus_pipeline.run(spark, d)
        assert got.count() == at.count() == max(0, n - 1)
