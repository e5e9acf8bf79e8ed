"""Properties of operators that SQL can't express, stores, streams and plans."""

import gc
import json
import math
import re
import tracemalloc
import unicodedata

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from docloom.functions import text as T
from docloom.operators import chunking as C
from docloom.functions import lines as L
from docloom.operators import figures as G
from docloom.operators.index import Index, Registry, _nearest, bm25, bm25_documents, knn, postings, registry_merge
from docloom.plans.etl import Config, chunks, model_names, splitter_chain
from docloom.queries import ORACLE, QUERIES
from docloom.sources import files as S
from docloom.streaming.upsert import stream_upserts, windowed_counts

TEXT = st.text(alphabet=st.sampled_from("ab c.\n\n!"), max_size=400)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 40), st.integers(0, 30))
def test_recursive_pieces_cover_the_text(text, size, overlap):
    overlap = min(overlap, size - 1)
    out = C.recursive_pieces(text, size, overlap)
    assert all(0 < len(c) <= size for c in out)
    assert all(c in text for c in out)
    if overlap == 0:
        assert "".join("".join(out).split()) == "".join(text.split())
    assert all(w in " ".join(out) for w in text.split() if len(w) <= size)


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_semantic_pieces_lose_nothing(text):
    out = C.semantic_pieces(text, 30, C.hash_embed_values)
    assert "".join("".join(out).split()) == "".join(text.split())


def test_hash_embedding_is_of_unit_length_and_repeatable():
    v = C.hash_embed_values("Some words and more")
    assert abs(sum(x * x for x in v) - 1) < 1e-9 and v == C.hash_embed_values("some WORDS, and more")
    assert C.hash_embed_values("") == C.hash_embed_values(None) == [0.0] * 64


def test_compatibility_normalisation(spark):
    rows = ["ﬁ①", "Å", "", None, "ｱ", "x²"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "s string").select(T.nfkc(F.col("s"))).collect()]
    assert got == [x if x is None else unicodedata.normalize("NFKC", x) for x in rows]


def test_normalisation_takes_no_python_worker(spark):
    md = spark.createDataFrame([("ﬁ a\u0301 \u1e9b\u0323 \uac00\u11a8 한 ㌀",)], "s string")
    plan = md.select(T.normalize_markdown(F.col("s")).alias("md"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.first().md == unicodedata.normalize("NFKC", md.first().s)


def test_documents_are_worked_on_in_small_pieces(spark):
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array([None, "x" * 1000] * 50), pa.array([["y"] * i for i in range(100)])], ["doc_id", "md", "l"])
    parts = list(L.pieces(batch, 4000))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and all(p.nbytes <= 4000 for p in parts) and len(parts) < 40
    assert [len(p) for p in L.pieces(pa.array(["x" * 9000, "", "y"]), 4000)] == [1, 2] and len(list(L.pieces(batch.slice(0, 0), 0))) == 1
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") != 7, F.repeat(F.lit("one line\n"), 20_000)).alias("md"), F.array(F.lit("mark")).alias("l")).coalesce(1)
    alive = lambda *_: sum(type(x) is list and x == ["mark"] for x in gc.get_objects())  # noqa: E731 - the rows that Python holds at once
    seen = L.each_document(docs, ["md", "l"], lambda *_: [(alive(),)], "alive int").collect()
    assert sorted(r.doc_id for r in seen) == [x for x in range(40) if x != 7] and max(r.alive for r in seen) < 10
    same = docs.select("doc_id", L.each_text(lambda md, l: alive(), IntegerType())("md", "l").alias("alive")).collect()
    assert [r.doc_id for r in same if r.alive is None] == [7] and max(r.alive or 0 for r in same) < 10 and len(same) == 40


def test_normalisation_order(spark):
    cases = {"a [...] b\nkeep": "keep", "x\r\ny\rz": "x\ny\rz", "a-\nb-\nc": "ab-\nc", "a \t b": "a b", "a\n\n\n\nb": "a\n\nb", "  a ": "a", "so­ft": "soft", "a […] b": "a [...] b"}
    got = [r[0] for r in spark.createDataFrame([(x,) for x in cases], "s string").select(T.normalize_markdown(F.col("s"))).collect()]
    assert got == list(cases.values())


def test_page_anchors_are_found_in_order(spark, sf_dir):
    got = QUERIES["page_anchors"](spark, sf_dir).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.page)):
        by.setdefault(r.doc_id, []).append(r.off)
    assert all(o == sorted(o) for o in by.values())


def test_placed_figures_all_appear_once(spark, sf_dir):
    for r in QUERIES["place_figures"](spark, sf_dir).collect():
        assert sorted(re.findall(r"FIG_\d{3}_\d{2}(?= ?-->)", r.md)) == ["FIG_001_01", "FIG_001_02", "FIG_001_03", "FIG_002_01"]


def test_catalog_survives_json(spark):
    rows = [("d", "FIG_001_01", "a.png", "d.pdf", 1, [1.0, 2.0, 3.0, 4.0], None), ("d", "FIG_002_01", "b.png", "d.pdf", 2, [0.0] * 4, "cap")]
    df = spark.createDataFrame(rows, "doc_id string, id string, imagepath string, filepath string, page int, bbox array<double>, caption string")
    stored = S.catalog_json(df)
    assert "caption" not in json.loads(stored.first().json)[0]
    assert sorted(map(tuple, S.catalog_load(stored).select(*df.columns).collect())) == sorted(rows)
    one = spark.createDataFrame([("e", '{"id": "x", "page": 3}')], "doc_id string, json string")
    assert S.catalog_load(one).first().page == 3
    with pytest.raises(Exception):
        S.catalog_load(spark.createDataFrame([("e", "[{")], "doc_id string, json string")).collect()


def test_splitter_chains():
    assert splitter_chain() == []
    assert [s["splitter"] for s in splitter_chain("markdown", True)] == ["markdown"]
    assert [s["splitter"] for s in splitter_chain("recursive", True, 3)] == ["markdown", "recursive"]
    with pytest.raises(ValueError):
        splitter_chain("unknown")


CONFIG = {
    "app": {
        "indexing": {"name": "docs", "description": "d", "type": "faiss", "distance": "cosine", "alias": "x"},
        "embeddings": {"deployment": "org/model", "ollama": True, "kwargs": {}},
        "preprocessing": {
            "storage": {"parent_folder": "data", "input_folder": "in", "output_folder": "md", "allowed_extensions": ["pdf"]},
            "images": {"dpi": 200, "tol": 40.0, "pad": 16.0, "caption_keywords": ["Figure"]},
            "chunking": {"markdown_first": True, "header_levels": 4, "splitter": "recursive", "chunk_size": 1000, "chunk_overlap": 200},
        },
    }
}


def test_configurations(spark):
    for app in ("app", None):
        c = Config.load(json.dumps(CONFIG), app)
        assert (c.source, c.folder, c.allowed, c.model, c.kind, c.distance, c.tol) == ("data/in", "data/md", ["pdf"], "org/model", "flat", "cosine", 40.0)
        assert c.stages == [{"splitter": "markdown", "header_levels": 4}, {"splitter": "recursive", "chunk_size": 1000, "chunk_overlap": 200}]
    for path, value in ((("indexing", "distance"), "hamming"), (("indexing", "type"), "other"), (("indexing", "colour"), "red"), (("preprocessing", "chunking", "splitter"), "unknown"), (("preprocessing", "storage", "allowed_extensions"), ["exe"])):
        bad = json.loads(json.dumps(CONFIG))
        at = bad["app"]
        for k in path[:-1]:
            at = at[k]
        at[path[-1]] = value
        with pytest.raises(ValueError):
            Config.load(json.dumps(bad))
    with pytest.raises(ValueError):
        Config.load("{}")
    with pytest.raises(ValueError):
        Config.load(json.dumps(CONFIG), "missing")
    several = json.loads(json.dumps(CONFIG))
    several["app"]["embeddings"]["deployment"] = ["b", "a/b", "no good", "b"]
    rows = spark.createDataFrame([(json.dumps(CONFIG),), (json.dumps(several),), ("{}",)], "json string")
    assert [r.name for r in model_names(rows, "app").collect()] == ["a/b", "b", "org/model"]


def test_splitters_can_be_added(spark):
    C.register_splitter("halves", lambda rows, s: C._spread(rows, F.array(F.substring("page_content", 1, s["at"]), F.substring("page_content", s["at"] + 1, 10**6))))
    try:
        assert splitter_chain("halves")[0]["splitter"] == "halves"
        got = C.chunk_metadata(C.split_chain(spark.createDataFrame([(1, "abcdef")], "doc_id long, md string"), [{"splitter": "halves", "at": 2}]), F.lit("f")).collect()
        assert [r.page_content for r in sorted(got, key=lambda r: r.chunk_idx)] == ["ab", "cdef"]
        with pytest.raises(ValueError):
            C.register_splitter("halves", None)
    finally:
        del C.SPLITTERS["halves"]


def test_order_holds_over_a_million_pieces(spark):
    rows = C._spread(C.whole(spark.createDataFrame([(1, "x")], "doc_id long, md string")), F.transform(F.sequence(F.lit(0), F.lit(1_000_001)), lambda i: i.cast("string")))
    last = C._spread(rows.where("page_content >= '1000000' or page_content = '2'"), F.array("page_content"))
    got = [r.page_content for r in C.chunk_metadata(last, F.lit("f")).orderBy("chunk_idx").collect()]
    assert got.index("2") < got.index("1000000") < got.index("1000001")


def test_batches_of_an_embedding_model(spark):
    embed = C.embedder(lambda: lambda texts: [[len(t), len(texts) > 0] for t in texts])
    got = spark.createDataFrame([("ab",), (None,)], "t string").select(embed("t").alias("v")).collect()
    assert sorted(r.v for r in got) == [[0.0, 1.0], [2.0, 1.0]]


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("a.b.pdf", "# Hé"), ("c.pdf", ""), ("d.pdf", None)], "filename string, md string")
    for _ in range(2):
        assert S.write_markdown(docs, str(tmp_path / "md")) == 2
    assert {p.name: p.read_text() for p in (tmp_path / "md").iterdir()} == {"a.b.md": "# Hé", "c.md": ""}
    assert sorted(r.md for r in S.read_markdown(spark, str(tmp_path / "md" / "a*.md")).collect()) == ["# Hé"]
    entries = [("d1", "FIG_001_01", "d1/FIG_001_01.png", "d1.pdf", 1, [0.0, 0.0, 36.0, 72.5], None), ("d1", "FIG_002_01", "d1/FIG_002_01.png", "d1.pdf", 2, [0.0] * 4, "é")]
    catalog = spark.createDataFrame(entries, "doc_id string, id string, imagepath string, filepath string, page int, bbox array<double>, caption string")
    assert S.write_catalogs(catalog, str(tmp_path / "cat")) == 1
    text = (tmp_path / "cat" / "d1.json").read_text()
    assert text.startswith('[\n  {\n    "id": "FIG_001_01"') and "é" in text and json.loads(text)[0].keys() == {"id", "imagepath", "filepath", "page", "bbox"}
    assert S.load_catalogs(spark, str(tmp_path / "cat")).count() == 2
    stored, two = S.catalog_json(catalog), spark.createDataFrame([("d1",), ("d2",)], "doc_id string")
    assert S.catalogs(two, stored, lambda d: d.select("doc_id", *(F.lit(None).cast(f.dataType).alias(f.name) for f in S.CATALOG.fields))).count() == 3
    assert S.catalogs(two.where("doc_id = 'd1'"), stored).count() == 2
    with pytest.raises(Exception, match="no catalog of d2"):
        S.catalogs(two, stored).collect()
    assert [(r.width, r.height) for r in S.render_sizes(catalog, 200).orderBy("page").collect()] == [(100, 202), (0, 0)]
    assert S.write_figures(catalog, lambda f, p, b, dpi: f"{f} {p} {dpi}".encode(), str(tmp_path / "img"), 72) == 2
    assert (tmp_path / "img" / "d1" / "FIG_002_01.png").read_bytes() == b"d1.pdf 2 72"
    path = S.write_metadata(spark.createDataFrame([("a", None, 3)], "filename string, note string, n_pages int"), str(tmp_path), "org/model")
    assert path.endswith("documents_metadata_org_model.json") and spark.read.json(path).first().asDict() == {"filename": "a", "n_pages": 3}


MARKDOWN = st.lists(st.sampled_from(["", " ", "\t", "text", "# head", "   ## two", "    # deep", "#no", "---", "*** ", "____", "--", "```", "```py", "Figure 1", "Figures", " Figure", "Table", "\u00a0", "a # b"]), max_size=14).map("\n".join)


def least_break(md, start):
    """Independent form: all candidates by regular expressions, then the least."""
    s = md[start:]
    free = lambda at: len(re.findall(r"(?m)^```", s[:at])) % 2 == 0
    found = [m.start() for m in re.finditer(r"\n(?=\s*\n)", s) if free(m.start())]
    found += [m.end() for m in re.finditer(r"\n(?:-{3,}|\*{3,}|_{3,})\s*(?:\n|$)", s) if free(m.start())]
    found += [m.end() for m in re.finditer(r"(?m)^(?:(?!\n)\s){0,3}#{1,6}(?:(?!\n)\s.*)?$", s) if free(m.start())]
    return start + min(found) if found else start


@settings(max_examples=600, deadline=None)
@given(MARKDOWN, st.integers(0, 60))
def test_breaks_are_the_least_candidate(md, start):
    start = min(start, len(md) + 2)
    assert L.find_break(md, start) == least_break(md, start)


@settings(max_examples=300, deadline=None)
@given(MARKDOWN, st.integers(0, 40), st.integers(0, 60))
def test_captions_in_a_slice(md, start, stop):
    want = []
    at = 0
    lines = md.split("\n")
    for a, b in zip(lines, lines[1:]):
        nxt = at + len(a) + 1
        word = re.match(r"(Figure|Table)", b)
        if not a.strip(" \t") and word and at >= start and nxt + word.end() <= stop and (nxt + word.end() == stop or not re.match(r"\w", b[word.end() :])):
            want.append(at)
        at = nxt
    assert L.find_captions(md, ["Figure", "Table"], start, stop) == want


def test_captions_of_several_slices_take_one_pass(spark, sf_dir):
    docs = spark.createDataFrame([(1, "x\n\nFigure 1\n \t\nTable", 2, 9), (2, None, 0, 1), (3, "\nFigures\n\nFigure", 0, 8)], "doc_id long, md string, a int, b int")
    got = L.caption_parts(docs, ["Figure", "Table"], {"all": (None, None), "some": ("a", "b")})
    assert sorted(map(tuple, got.collect())) == [(1, 2, "all"), (1, 2, "some"), (1, 12, "all"), (3, 9, "all")]
    plan = QUERIES["caption_spots"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_strip_takes_all_kinds_of_space(spark):
    rows = [f"{c}{c} a{c}b {c}" for c in map(chr, [*range(1, 0x3100), 0xFEFF])] + ["", " ", "\u3000", None]
    df = spark.createDataFrame([(x,) for x in rows], "s string").select(T.strip(F.col("s")).alias("a"), F.regexp_replace("s", rf"\A{T.SPACE}+|{T.SPACE}+\z", "").alias("b"))
    assert all(r.a == r.b for r in df.collect())


def test_break_of_a_rule_with_a_blank_line_behind():
    assert L.find_break("a\n---\n\nfoo") == 5 and L.find_break("a\n---\nfoo") == 6 and L.find_break("x", 7) == 7


@settings(max_examples=200, deadline=None)
@given(MARKDOWN, st.lists(st.tuples(st.integers(1, 3), st.integers(0, 3)), max_size=6))
def test_figures_are_placed_page_by_page(md, figs):
    third = len(md) // 3
    rows = [{"page": p, "start": (p - 1) * third, "stop": p * third if p < 3 else len(md), "y0": float(y), "id": f"F{i}", "txt": f"<{i}>"} for i, (p, y) in enumerate(figs)]
    got = G.find_places(md, rows, ["Figure"])
    want, used, cursor = [], set(), {}
    for r in sorted(rows, key=lambda r: (r["page"], r["y0"], r["id"])):
        spots = [s for s in L.find_captions(md, ["Figure"], r["start"], r["stop"]) if (r["page"], s) not in used]
        if spots:
            used.add((r["page"], spots[0]))
            want.append((spots[0], r["txt"]))
        else:
            at = least_break(md, cursor.get(r["page"], r["start"]))
            cursor[r["page"]] = at + len(r["txt"])
            want.append((at, r["txt"]))
    assert [(a, t) for a, _, t in got] == want and [n for _, n, _ in got] == list(range(len(got)))


def test_placement_of_nothing_and_the_inserted_line(spark):
    fig = "array<struct<page: int, start: int, stop: int, y0: double, id: string, imagepath: string, caption: string>>"
    one = [(1, 0, 3, 0.0, "FIG_001_01", "i/x.png", None)]
    pages = spark.createDataFrame([(1, None, one), (2, "abc", None), (3, "abc", one), (4, "", [])], f"doc_id long, md string, figures {fig}")
    got = G.place_figures(pages, ["Figure"]).collect()
    assert [tuple(r) for r in got] == [(3, 0, 0, "\n\n![FIG_001_01](i/x.png) <!-- FIG_001_01 -->\n")]


def test_page_anchors_equal_a_search(spark):
    docs = spark.createDataFrame([(1, "One two. three four\nthree, four five six"), (2, None), (3, "")], "doc_id long, md string")
    pages = spark.createDataFrame([(1, 1, "One two"), (1, 2, "three four five"), (1, 3, "gone"), (1, 4, "One"), (1, 5, "!!"), (2, 1, "x"), (4, 2, "y")], "doc_id long, page int, text string")
    got = sorted(map(tuple, G.page_anchors(docs, pages).collect()))
    assert got == [(1, 1, -1), (1, 2, 19), (1, 3, 19), (1, 4, 19), (1, 5, 19), (2, 1, -1), (4, 2, -1)]


def test_header_splitter_must_come_first(spark):
    docs = spark.createDataFrame([(1, "# a\nb")], "doc_id long, md string")
    with pytest.raises(ValueError):
        C.split_chain(docs, [{"splitter": "window"}, {"splitter": "markdown"}])
    assert C.split_chain(docs, []).count() == 0


def test_files_to_chunks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# One\nfirst\n## Two\nsecond")
    (tmp_path / "b.TXT").write_text("plain")
    (tmp_path / "bad.txt").write_bytes(b"boom")
    (tmp_path / "c.exe").write_text("no")

    def decoder(content):
        if bytes(content) == b"boom":
            raise ValueError("broken")
        return [bytes(content).decode()]

    good, rejected = chunks(S.scan_folder(spark, str(tmp_path)), Config(stages=splitter_chain("window", True)), decoder)
    got = sorted((r.filename, r.chunk_idx, r.page_content, tuple(sorted(r.headers.items()))) for r in good.collect())
    assert got == [("out/a.md", 0, "first", (("Header 1", "One"),)), ("out/a.md", 1, "second", (("Header 1", "One"), ("Header 2", "Two"))), ("out/b.md", 0, "plain", ())]
    assert sorted((r.filepath.rsplit("/", 1)[1], "broken" in r.reason or r.reason) for r in rejected.collect()) == [("bad.txt", True), ("c.exe", "format")]


def rows_of(spark, *names):
    return spark.createDataFrame([(n, i, f"text of {n}") for i, n in enumerate(names)], "filename string, chunk_idx int, page_content string")


def test_index_life(spark, tmp_path):
    index = Index(spark, str(tmp_path / "ix"))
    assert not index.exists()
    index.create(rows_of(spark, "a", "a", "b"))
    index.create(rows_of(spark, "z"))  # it exists: nothing happens
    index.add(rows_of(spark, "c"))
    assert index.count() == 4
    index.upsert(rows_of(spark, "a", "b").select("filename"), rows_of(spark, "a"))  # b is cleared
    assert sorted(r.filename for r in index.load().collect()) == ["a", "c"]
    assert index.delete(rows_of(spark, "c", "missing")) == 1 and index.delete(rows_of(spark, "missing")) == 0
    assert index.count() == 1
    index.drop()
    assert not index.exists()


def test_a_half_written_version_is_not_read(spark, tmp_path):
    index = Index(spark, str(tmp_path / "ix"))
    index.create(rows_of(spark, "a"))
    (tmp_path / "ix" / "rows" / "index_edit=v7-dead" / "index_segment=0").mkdir(parents=True)
    assert index.version() == 0 and index.count() == 1
    before = index.load()
    index.add(rows_of(spark, "b"))
    assert index.version() == 1 and index.count() == 2
    assert before.count() == 1 and index.load(0).count() == 1  # readers keep what they began with
    index.delete(rows_of(spark, "a"))
    index.vacuum(1)
    assert index.count() == index.load().count() == 1 and not (tmp_path / "ix" / "rows" / "index_edit=v7-dead").exists()


def test_an_edit_writes_only_the_segments_that_it_touches(spark, tmp_path):
    index = Index(spark, str(tmp_path / "ix"), segments=64)
    index.create(rows_of(spark, *(f"f{i}" for i in range(100))))
    old = index._manifest()["segments"]
    index.upsert(rows_of(spark, "f1").select("filename"), rows_of(spark, "f1", "f1"))
    new = index._manifest()["segments"]
    assert sum(old[k] != new[k] for k in old) == 1 and index.count() == 101


def test_search_by_all_modes(spark, tmp_path):
    texts = {"a": "the red fox jumps", "b": "a blue whale sings", "c": "red red wine", "d": "completely other words here"}
    rows = spark.createDataFrame([(n, 0, t) for n, t in texts.items()], "filename string, chunk_idx int, page_content string")
    index = Index(spark, str(tmp_path / "ix"), kind="hybrid", embed=C.hash_embed, segments=3)
    assert index.open(rows) is index
    norms = [sum(x * x for x in r.embedding) for r in index.load().collect()]
    assert all(abs(n - 1) < 1e-9 for n in norms)
    posts = {(r.term, r.tf, r.dl) for r in index.postings().collect()}
    assert ("red", 2, 3) in posts and ("red", 1, 4) in posts
    asked = spark.createDataFrame([(1, "red wine"), (2, "whale")], "query_id long, text string")
    for mode in Index.MODES:
        first = {r.query_id: r.filename for r in index.search(asked, 2, mode).collect() if r.rank == 1}
        assert first == {1: "c", 2: "b"}, mode
    index.delete(spark.createDataFrame([("c",)], "filename string"))
    assert {r.filename for r in index.search(asked, 4, "sparse").where("query_id = 1").collect()} == {"a"}
    with pytest.raises(ValueError):
        Index(spark, str(tmp_path / "x")).search(asked, 1, "sparse")
    with pytest.raises(ValueError):
        Index(spark, str(tmp_path / "x"), mode="hybrid")
    with pytest.raises(FileNotFoundError):
        Index(spark, str(tmp_path / "x")).open()


def test_stored_registry(spark, tmp_path):
    schema = "name string, distance string, model string, types array<string>"
    r = Registry(spark, str(tmp_path / "reg"))
    assert r.load().count() == 0
    r.merge(spark.createDataFrame([("a", "cosine", "m", ["flat"])], schema))
    r.merge(spark.createDataFrame([("a", "cosine", "m", ["hybrid"]), ("b", "euclidean", "m", ["flat"])], schema))
    assert sorted((x.name, tuple(x.types)) for x in r.load().collect()) == [("a", ("flat", "hybrid")), ("b", ("flat",))]


def test_stream_of_documents_replaces_files(spark, tmp_path):
    index = Index(spark, str(tmp_path / "ix"))
    index.create(rows_of(spark, "a", "a", "k"))
    src = str(tmp_path / "in")
    schema = "filename string, md string, ts long"
    to_rows = lambda df: df.select("filename", F.lit(0).alias("chunk_idx"), F.col("md").alias("page_content"))
    for batch in ([("a", "old", 1), ("a", "new", 2)], [("b", "first", 3)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        stream_upserts(spark.readStream.schema(schema).parquet(src), index, to_rows, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.filename, r.page_content) for r in index.load().collect()) == [("a", "new"), ("b", "first"), ("k", "text of k")]


def test_windowed_counts_close_with_the_watermark(spark, tmp_path):
    src = str(tmp_path / "ev")
    schema = "ts timestamp, event_type string"
    spark.sql("SELECT timestamp'2024-01-01 10:05:00' AS ts, 'x' AS event_type UNION ALL SELECT timestamp'2024-01-01 10:50:00', 'x' UNION ALL SELECT timestamp'2024-01-01 13:00:00', 'y'").coalesce(1).write.parquet(src)
    q = windowed_counts(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("counts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.event_type, r.n) for r in spark.table("counts").collect()] == [("x", 2)]


def test_search_in_groups_equals_search_at_once(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    q = v.where("vec_id % 100 = 0")
    a, b = (sorted(map(tuple, knn(v, q, 3, query_bytes=n).collect())) for n in (1 << 26, 1000))
    assert a == b and len(a) == 3 * q.count()


def test_rounded_components_keep_the_sign_of_zero(spark, tmp_path):
    spark.createDataFrame([(1, [1.0, -1e-9, 1e-9, -0.0, -0.25]), (2, [0.6, -0.8, 0.0, 2e-7, -6e-7])], "vec_id long, embedding array<double>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = [repr(r) for r in sorted(con.execute(ORACLE["l2_normalize"]).fetchall())]
    assert [repr(tuple(r)) for r in sorted(QUERIES["l2_normalize"](spark, str(tmp_path)).collect())] == want and "-0.0" in want[0]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_search_holds_few_scores_at_once_and_passes_on_the_best_of_a_task(metric):
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (6000, 4)).astype(float)  # with many ties and copies
    ids = rng.permutation(6000)
    lists = [None if i % 97 == 0 else [*v[:3], None] if i % 89 == 0 else [*v[:3], math.inf] if i % 83 == 0 else v.tolist() for i, v in zip(ids, x)]
    good = np.array([v is not None and None not in v and math.inf not in v for v in lists])
    asked = np.flatnonzero(good)[:1500]
    table = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lists, pa.list_(pa.float64()))], ["vec_id", "embedding"])
    tracemalloc.start()
    found = list(_nearest(ids[asked], x[asked], 5, metric, False, 1 << 16)(iter([table.slice(0, 2500), table.slice(2500, 0), table.slice(2500)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = {}
    for b in found:
        for q, i, s in zip(*(c.to_pylist() for c in b.columns)):
            got.setdefault(q, []).append((i, s))
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    for a in asked[:200]:
        score = np.round(unit @ unit[a], 6) if metric == "cosine" else np.round(np.sqrt(((x - x[a]) ** 2).sum(1)), 6)
        key = np.where(good & (ids != ids[a]), -score if metric == "cosine" else score, np.inf)
        assert got[ids[a]] == [(ids[j], score[j]) for j in np.lexsort((ids, key))[:5]]
    assert len(got) == 1500 and all(len(v) == 5 for v in got.values())
    assert peak < 16 << 20  # all scores at once have 72 MB


def test_postings_are_not_shuffled(spark):
    docs = spark.createDataFrame([(1, "b a B c"), (2, ""), (3, None), (4, "É a1 _ a1")], "doc_id long, text string")
    posts = postings(docs)
    assert "Exchange" not in posts._jdf.queryExecution().executedPlan().toString()
    assert sorted(posts.select("doc_id", "term", "dl", "tf").collect()) == [(1, "a", 4, 1), (1, "b", 4, 2), (1, "c", 4, 1), (4, "_", 4, 1), (4, "a1", 4, 2), (4, "é", 4, 1)]
    some = postings(docs, only=spark.createDataFrame([("a1",), ("b",), ("b",)], "term string"))
    assert sorted(some.select("doc_id", "term", "dl", "tf").collect()) == [(1, "b", 4, 2), (4, "a1", 4, 2)]


@pytest.mark.parametrize("rows", [[(1, "red fox"), (2, None), (3, ""), (4, "red red wine"), (5, "fox")], [(1, "red fox"), (1, "fox red"), (1, "wine red fox"), (2, None), (3, "wine"), (None, "red"), (None, "wine wine")]])
def test_keyword_search_of_odd_documents_equals_sql(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(7, "red wine red"), (8, "fox"), (9, "none")], "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for name, columns in (("bm25_postings", "doc_id, term, dl, tf"), ("bm25_search", "query_id, doc_id, score, rank")):
        want = con.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
        assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).select(*columns.split(", ")).collect()), key=repr) == sorted(want, key=repr), name


def test_scores_of_documents_equal_those_of_postings_and_pairs_are_not_shuffled(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.expr("array_join(transform(sequence(0, id % 23), i -> concat('w', (id * 7 + i * i) % 40)), ' ')").alias("text")).coalesce(3)
    asked = spark.range(1500).select(F.col("id").alias("query_id"), F.explode(F.expr("transform(sequence(0, id % 4), i -> concat('w', (id + 5 * i) % 50))")).alias("term"))
    n, total = docs.count(), postings(docs).agg(F.sum("tf")).first()[0]
    want = bm25(postings(docs), n, total / n, asked, 4).select("query_id", "doc_id", "score", "rank").collect()
    for cells in (1 << 20, 3000):
        got = bm25_documents(docs, asked, 4, cells=cells)
        assert sorted(got.select("query_id", "doc_id", "score", "rank").collect()) == sorted(want)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # of the k best of each task


def test_registry_keeps_other_rows(spark):
    schema = "name string, distance string, model string, types array<string>"
    got = registry_merge(spark.createDataFrame([("a", "cosine", "m", ["flat"]), ("b", "l2", "m", ["flat"])], schema), spark.createDataFrame([("a", "cosine", "m", ["hybrid"]), ("c", "l2", "n", ["flat"])], schema))
    assert sorted((r.name, tuple(r.types)) for r in got.collect()) == [("a", ("flat", "hybrid")), ("b", ("flat",)), ("c", ("flat",))]
