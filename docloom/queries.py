"""The registered queries for the document operators, each with SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixtures as X
from .functions import lines as L
from .functions import text as T
from .operators import chunking as C
from .operators import figures as G
from .operators import index as I
from .operators import metadata as M
from .plans.etl import splitter_chain
from .sources import files as S

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def _url_names(spark: SparkSession, d: str) -> DataFrame:
    literals = spark.createDataFrame([("X.PDF",), ("noext",), ("a.b.pdf",), ("mypdf",), (".pdf",)], "name string")
    return X.table(spark, d, "pages").select(F.concat(F.element_at(F.split("url", "/"), -1), F.element_at(F.array(F.lit(".html"), F.lit(".txt"), F.lit(".PDF")), (F.col("page_id") % 3 + 1).cast("int"))).alias("name")).unionByName(literals)


_NAMES = "names AS (SELECT list_extract(string_split(url, '/'), -1) || (CASE page_id % 3 WHEN 0 THEN '.html' WHEN 1 THEN '.txt' ELSE '.PDF' END) AS name FROM pages UNION ALL SELECT unnest(['X.PDF', 'noext', 'a.b.pdf', 'mypdf', '.pdf']))"
_EXT = "lower(list_extract(string_split(name, '.'), -1))"


@query(f"WITH {_NAMES} SELECT name, ext FROM names, (SELECT unnest(['pdf', '.pdf', 'txt']) AS ext) WHERE ends_with(lower(name), ext)")
def scan_allowed(spark, d):
    return S.allowed_names(_url_names(spark, d), ["pdf", ".pdf", "txt"])


@query(f"WITH {_NAMES} SELECT name, {_EXT} AS ext, {_EXT} IN ('pdf','xps','epub','mobi','fb2','cbz','svg','txt') AS supported FROM names")
def ext_detect(spark, d):
    return _url_names(spark, d).select("name", S.extension(F.col("name")).alias("ext"), S.extension(F.col("name")).isin(*S.SUPPORTED).alias("supported"))


@query(f"WITH {_NAMES} SELECT name FROM names WHERE {_EXT} IN ('pdf', 'svg')")
def ext_filter(spark, d):
    return _url_names(spark, d).where(S.accepted(F.col("name"), ["pdf", "svg", "html"]))


def _sql_html() -> str:
    x = "html"
    for pattern, to in T.HTML_STEPS:
        x = f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to.replace(chr(39), chr(39) * 2)}', 'g')"
    return f"SELECT page_id, {X.sql_strip(x)} AS md FROM pages"


@query(_sql_html())
def html_to_markdown(spark, d):
    return X.table(spark, d, "pages").select("page_id", T.html_to_markdown(F.col("html")).alias("md"))


@query("SELECT l_orderkey AS doc, CAST(l_linenumber AS INTEGER) AS page, CAST(1 AS INTEGER) AS type, CAST(l_quantity AS DOUBLE) AS x0 FROM lineitem WHERE l_linenumber % 2 = 1 AND l_partkey % 5 <> 0")
def image_blocks(spark, d):
    box = F.when(F.col("l_partkey") % 5 != 0, F.array(F.col("l_quantity").cast("double")))
    pages = X.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), F.array(F.struct((F.col("l_linenumber") % 2).cast("int").alias("type"), box.alias("bbox"))).alias("blocks"))
    return S.image_blocks(pages).select("doc", "page", F.col("block.type").alias("type"), F.col("block.bbox")[0].alias("x0"))


def _step(name: str):
    f = getattr(T, name)

    def run(spark, d):
        return X.augmented(spark, d).select("doc_id", f(F.col("md")).alias("md"))

    run.__name__ = name
    query(f"WITH {X.AUG} SELECT doc_id, {X.SQL_STEPS[name]('md')} AS md FROM aug")(run)


for _name in X.SQL_STEPS:
    _step(_name)


@query(f"WITH {X.AUG} SELECT doc_id, md || 'fi1' AS md FROM aug")  # the texts are their own form but for what is added
def nfkc(spark, d):
    return X.augmented(spark, d).select("doc_id", T.nfkc(F.concat("md", F.lit("ﬁ①"))).alias("md"))


def _normalized(spark, d) -> DataFrame:
    return X.augmented(spark, d).select("doc_id", T.normalize_markdown(F.col("md")).alias("md"))


@query(f"WITH {X.NORM} SELECT doc_id, md FROM norm")
def normalize_markdown(spark, d):
    return _normalized(spark, d)


_SNIP = rf"coalesce(substr(list_extract(list_filter(list_transform(string_split(md, chr(10)), lambda l: {X.sql_strip('l')}), lambda l: length(l) >= 50), 1), 1, 200), {X.sql_strip('substr(md, 1, 200)')})"


@query(f"WITH {X.NORM} SELECT doc_id, {_SNIP} AS snippet FROM norm")
def page_snippet(spark, d):
    return _normalized(spark, d).select("doc_id", T.page_snippet(F.col("md")).alias("snippet"))


@query(rf"WITH {X.NORM} SELECT doc_id, array_to_string(list_slice(regexp_extract_all({_SNIP}, '[\p{{L}}\p{{N}}_]+'), 1, 10), '|') AS tokens FROM norm")
def anchor_tokens(spark, d):
    return _normalized(spark, d).select("doc_id", F.array_join(T.anchor_tokens(T.page_snippet(F.col("md"))), "|").alias("tokens"))


@query(rf"""SELECT item_id, coalesce(nullif(regexp_replace({X.sql_strip(rf"regexp_replace({X.sql_strip('c')}, '{X.SPACE}+', ' ', 'g')")}, '[\[\]()]', '', 'g'), ''), 'image') AS alt
  FROM (SELECT item_id, CASE item_id % 4 WHEN 0 THEN ' [' || text || '] ' || chr(10) || ' (x)' WHEN 1 THEN 'FIG_' || item_id WHEN 2 THEN '[]' ELSE text END AS c FROM benchmark)""")
def alt_text(spark, d):
    k = F.col("item_id") % 4
    cap = F.when(k == 0, F.concat(F.lit(" ["), F.col("text"), F.lit("] \n (x)"))).when(k == 1, F.lit("")).when(k == 2, F.lit("[]")).otherwise(F.col("text"))
    return X.table(spark, d, "benchmark").select("item_id", T.alt_text(cap, F.concat(F.lit("FIG_"), F.col("item_id"))).alias("alt"))


@query("SELECT DISTINCT l_orderkey % 2000 AS page, l_partkey % 130 AS k, printf('FIG_%03d_%02d', l_orderkey % 2000, l_partkey % 130) AS id FROM lineitem")
def figure_ids(spark, d):
    r = X.table(spark, d, "lineitem").select((F.col("l_orderkey") % 2000).alias("page"), (F.col("l_partkey") % 130).alias("k")).distinct()
    return r.withColumn("id", T.figure_id(F.col("page"), F.col("k")))


@query(rf"WITH {_NAMES} SELECT name, 'out/' || regexp_replace(name, '(.)\.[^.]*$', '\1') || '.md' AS md_filepath, 'out/' || regexp_replace(name, '(.)\.[^.]*$', '\1') || '_images' AS image_folder FROM names")
def output_paths(spark, d):
    return M.output_paths(_url_names(spark, d), "out")


def _lines(spark, d) -> DataFrame:
    return L.line_table(_normalized(spark, d))


_KW = rf"regexp_matches(line, '^(Figure|Table)([^\p{{L}}\p{{N}}_]|$)')"


@query(rf"""WITH {X.LINES}, p AS (SELECT doc_id, line, off, size, lag(blank) OVER w AS above, lag(off) OVER w AS spot FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY ln)),
k AS (SELECT *, CASE WHEN starts_with(line, 'Figure') THEN 6 ELSE 5 END AS n FROM p WHERE above AND regexp_matches(line, '^(Figure|Table)'))
SELECT doc_id, spot, 'all' AS part FROM p WHERE above AND {_KW}
UNION ALL SELECT doc_id, spot, 'slice' FROM k WHERE spot >= size // 4 AND off + n <= size - size // 3 AND ({_KW} OR off + n = size - size // 3)""")
def caption_spots(spark, d):
    ends = {"a": F.floor(F.length("md") / 4), "b": F.length("md") - F.floor(F.length("md") / 3)}
    return L.caption_parts(_normalized(spark, d).withColumns(ends), ["Figure", "Table"], {"all": (None, None), "slice": ("a", "b")})


def _sql_breaks() -> str:
    """Content breaks from each start on, over the lines of the rest of the text."""
    key = "doc_id, start"
    return rf"""WITH {X.NORM}, cut AS (SELECT doc_id, s AS start, substr(md, s + 1) AS md FROM (SELECT doc_id, md, unnest([0, length(md) // 3, length(md)]) AS s FROM norm)),
raw AS (SELECT {key}, length(md) AS size, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) - 1 AS ln FROM (SELECT DISTINCT * FROM cut)),
l AS (SELECT *, coalesce(sum(length(line) + 1) OVER w, 0) AS off, regexp_replace(line, '{X.SPACE}+', '', 'g') = '' AS blank, coalesce(sum(CASE WHEN starts_with(line, '```') THEN 1 ELSE 0 END) OVER w, 0) % 2 = 0 AS free
  FROM raw WINDOW w AS (PARTITION BY {key} ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT {key}, least(
  CASE WHEN free AND regexp_matches(line, '^{X.SPACE}{{0,3}}#{{1,6}}({X.SPACE}|$)') THEN off + length(line) END,
  CASE WHEN free AND ln > 0 AND regexp_matches(line, '^(-{{3,}}|\*{{3,}}|_{{3,}}){X.SPACE}*$') THEN coalesce(min(CASE WHEN NOT blank THEN off END) OVER (PARTITION BY {key} ORDER BY ln ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), size) END,
  CASE WHEN free AND blank AND ln > 0 AND lead(ln) OVER (PARTITION BY {key} ORDER BY ln) IS NOT NULL THEN off - 1 END) AS a FROM l)
SELECT doc_id, CAST(start AS INTEGER) AS start, CAST(start + coalesce(min(a), 0) AS INTEGER) AS brk FROM c GROUP BY {key}"""


@query(_sql_breaks())
def content_break(spark, d):
    n = _normalized(spark, d).withColumn("start", F.explode(F.array_distinct(F.array(F.lit(0), F.floor(F.length("md") / 3).cast("int"), F.length("md")))))
    return n.select("doc_id", "start", L.content_break(F.col("md"), F.col("start")).alias("brk"))


@query(f"WITH {X.LINES} SELECT doc_id, ln, nf % 2 = 1 AS inside FROM lines")
def fence_parity(spark, d):
    return _lines(spark, d).select("doc_id", "ln", (F.col("nf") % 2 == 1).alias("inside"))


def _conversations(spark, d):
    c = X.table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("page"), "text")
    docs = c.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n\n").alias("md"))
    return docs, c


_NW = r"[^\p{L}\p{N}_]"
_CONV_SNIP = rf"coalesce(substr(list_extract(list_filter(list_transform(string_split(text, chr(10)), lambda l: {X.sql_strip('l')}), lambda l: length(l) >= 50), 1), 1, 200), {X.sql_strip('substr(text, 1, 200)')})"


@query(rf"""WITH RECURSIVE md AS (SELECT conv_id AS doc_id, string_agg(text, chr(10) || chr(10) ORDER BY turn, text) AS md FROM conversations GROUP BY 1),
p AS (SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS page, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k,
  array_to_string(list_slice(regexp_extract_all({_CONV_SNIP}, '[\p{{L}}\p{{N}}_]+'), 1, 10), '{_NW}+') AS body FROM conversations),
rx AS (SELECT *, '(?s)^(.*?(?:^|{_NW}))' || body || '(?:{_NW}|$)' AS rx FROM p),
f AS (SELECT doc_id, 0::BIGINT AS k, 0::BIGINT AS low FROM md
  UNION ALL SELECT f.doc_id, rx.k, CASE WHEN rx.body <> '' AND regexp_matches(substr(md.md, f.low + 1), rx.rx) THEN f.low + length(regexp_extract(substr(md.md, f.low + 1), rx.rx, 1)) ELSE f.low END
  FROM f JOIN rx ON rx.doc_id = f.doc_id AND rx.k = f.k + 1 JOIN md ON md.doc_id = f.doc_id)
SELECT f.doc_id, p.page, CAST(f.low - 1 AS INTEGER) AS off FROM f JOIN p ON p.doc_id = f.doc_id AND p.k = f.k""")
def page_anchors(spark, d):
    return G.page_anchors(*_conversations(spark, d))


_RAW = "SELECT conv_id AS doc_id, CAST(turn AS INTEGER) AS page, CAST((turn * 137 + conv_id * 31) % 500 - 1 AS INTEGER) AS off FROM conversations"


def _raw_anchors(spark, d):
    return X.table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("page"), ((F.col("turn") * 137 + F.col("conv_id") * 31) % 500 - 1).cast("int").alias("off"))


_MONO = f"raw AS ({_RAW}), mono AS (SELECT doc_id, page, CAST(greatest(0, max(off) OVER (PARTITION BY doc_id ORDER BY page)) AS INTEGER) AS off FROM raw)"
_BOUNDS = f"{_MONO}, bounds AS (SELECT doc_id, page, off AS start, CAST(coalesce(lead(off) OVER (PARTITION BY doc_id ORDER BY page), 600) AS INTEGER) AS stop FROM mono)"


@query(f"WITH {_MONO} SELECT * FROM mono")
def monotone_anchors(spark, d):
    return G.monotone_anchors(_raw_anchors(spark, d))


def _bounds(spark, d):
    a = G.monotone_anchors(_raw_anchors(spark, d))
    return G.page_bounds(a, a.select("doc_id").distinct().withColumn("size", F.lit(600)))


@query(f"WITH {_BOUNDS} SELECT * FROM bounds")
def page_bounds(spark, d):
    return _bounds(spark, d)


@query(f"WITH {X.RECTS} SELECT doc, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM rects GROUP BY doc, page")
def bbox_union(spark, d):
    return G.union_boxes(X.rectangles(spark, d), "doc", "page")


@query(f"WITH {X.RECTS} SELECT a.doc, a.page, a.rid AS rid_a, b.rid AS rid_b FROM rects a JOIN rects b ON {X.SQL_TOUCH} AND a.rid < b.rid")
def rect_touch_pairs(spark, d):
    return G.touch_pairs(X.rectangles(spark, d), X.TOL)


@query(f"WITH {X.sql_merged()} SELECT * FROM merged")
def merge_rects(spark, d):
    return G.merge_rects(X.rectangles(spark, d), X.TOL)


@query(f"WITH {X.RECTS} SELECT doc, page, rid, greatest(x0 - 16, 0.0) AS x0, greatest(y0 - 16, 0.0) AS y0, least(x1 + 16, 612.0) AS x1, least(y1 + 16, 792.0) AS y1 FROM rects")
def pad_clip(spark, d):
    return G.pad_clip(X.rectangles(spark, d), 16, X.PAGE)


@query(f"WITH {X.FIGURES} SELECT * FROM figs")
def figure_order(spark, d):
    return G.figure_order(G.merge_rects(X.rectangles(spark, d), X.TOL))


def _catalog(spark, d):
    doc = F.col("doc").cast("string")
    return G.figure_catalog(G.merge_rects(X.rectangles(spark, d), X.TOL), 16, X.PAGE, F.concat(doc, F.lit("_images")), F.concat(doc, F.lit(".pdf")))


@query(f"WITH {X.FIGURES} SELECT doc, id, doc || '_images/' || id || '.png' AS imagepath, doc || '.pdf' AS filepath, page, x0, y0, x1, y1 FROM cat")
def figure_catalog(spark, d):
    return _catalog(spark, d).select("doc", "id", "imagepath", "filepath", "page", *(F.col("bbox")[i].alias(n) for i, n in enumerate(G.BOX)))


_ENTRY = """'{"id":"' || id || '","imagepath":"' || doc || '_images/' || id || '.png","filepath":"' || doc || '.pdf","page":' || page || ',"bbox":[' || x0 || ',' || y0 || ',' || x1 || ',' || y1 || ']}'"""


@query(f"WITH {X.FIGURES} SELECT doc AS doc_id, '[' || string_agg({_ENTRY}, ',' ORDER BY page, id) || ']' AS json FROM cat GROUP BY doc")
def catalog_json(spark, d):
    return S.catalog_json(_catalog(spark, d).withColumnRenamed("doc", "doc_id"))


@query(f"WITH {X.FIGURES} SELECT doc AS doc_id, id, doc || '_images/' || id || '.png' AS imagepath, doc || '.pdf' AS filepath, page, [x0, y0, x1, y1] AS bbox, CAST(NULL AS VARCHAR) AS caption FROM cat")
def catalog_load(spark, d):
    return S.catalog_load(S.catalog_json(_catalog(spark, d).withColumnRenamed("doc", "doc_id")))


@query(f"WITH {X.FIGURES}, {_BOUNDS} SELECT b.doc_id, b.page, b.start, b.stop, f.ids FROM (SELECT doc AS doc_id, page, string_agg(id, ',' ORDER BY y0, id) AS ids FROM cat GROUP BY 1, 2) f JOIN bounds b ON f.doc_id = b.doc_id AND f.page = b.page")
def page_figures(spark, d):
    return G.page_figures(_catalog(spark, d).withColumnRenamed("doc", "doc_id"), _bounds(spark, d)).select("doc_id", "page", "start", "stop", F.array_join("ids", ",").alias("ids"))


_SPOTS = "spots AS (SELECT conv_id AS doc_id, CAST(1 + turn % 3 AS INTEGER) AS page, CAST(turn * 100 AS INTEGER) AS spot FROM conversations)"


@query(f"""WITH {X.FIGURES}, {_SPOTS}, f AS (SELECT doc AS doc_id, page, id, y0, CAST(row_number() OVER (PARTITION BY doc, page ORDER BY y0, id) AS INTEGER) AS rn FROM cat),
s AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY spot) AS INTEGER) AS rn FROM spots)
SELECT f.doc_id, f.page, f.rn, f.id, f.y0, s.spot FROM f LEFT JOIN s ON f.doc_id = s.doc_id AND f.page = s.page AND f.rn = s.rn""")
def figure_caption_match(spark, d):
    spots = X.table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), (1 + F.col("turn") % 3).cast("int").alias("page"), (F.col("turn") * 100).cast("int").alias("spot"))
    figs = _catalog(spark, d).select(F.col("doc").alias("doc_id"), "page", "id", F.col("bbox")[1].alias("y0"))
    return G.figure_caption_match(figs, spots)


@query(f"""WITH {X.NORM}, e AS (SELECT conv_id AS doc_id, CAST((turn * 53) % 400 AS INTEGER) AS idx, turn AS seq, '<' || turn || '>' AS txt FROM conversations),
p AS (SELECT norm.doc_id, md, least(idx, length(md)) AS idx, seq, txt FROM norm JOIN e USING (doc_id)),
q AS (SELECT *, lead(idx) OVER w AS nxt, lag(idx) OVER w AS prv FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY idx, seq)),
t AS (SELECT doc_id, string_agg((CASE WHEN prv IS NULL THEN substr(md, 1, idx) ELSE '' END) || txt || substr(md, idx + 1, coalesce(nxt, length(md)) - idx), '' ORDER BY idx, seq) AS md FROM q GROUP BY doc_id)
SELECT norm.doc_id, coalesce(t.md, norm.md) AS md FROM norm LEFT JOIN t USING (doc_id)""")
def apply_insertions(spark, d):
    e = X.table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), ((F.col("turn") * 53) % 400).cast("int").alias("idx"), F.col("turn").alias("seq"), F.concat(F.lit("<"), F.col("turn"), F.lit(">")).alias("txt"))
    return G.apply_insertions(_normalized(spark, d), e)


@query()
def place_figures(spark, d):
    half = (F.length("md") / 2).cast("int")
    fig = lambda p, k, a, b: F.struct(F.lit(p).alias("page"), a.alias("start"), b.alias("stop"), F.lit(float(k)).alias("y0"), F.lit(f"FIG_{p:03d}_{k:02d}").alias("id"), F.lit(f"i/{p}_{k}.png").alias("imagepath"), F.lit(None).cast("string").alias("caption"))
    figs = F.array(*(fig(1, k, F.lit(0), half) for k in (1, 2, 3)), fig(2, 1, half, F.length("md")))
    n = _normalized(spark, d)
    return G.apply_insertions(n, G.place_figures(n.withColumn("figures", figs), ["Figure"]))


@query(f"WITH {X.HEADERS} SELECT doc_id, ln, lvl, h1, h2, h3, h4 FROM hd")
def header_path(spark, d):
    return L.header_lines(_normalized(spark, d))


def _place(rows: DataFrame) -> DataFrame:
    """The last place of a path as a number."""
    return rows.withColumn("pos", F.element_at("pos", -1).cast("long"))


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(*(c for c in rows.columns if c != "headers"), *(F.try_element_at("headers", F.lit(f"Header {k}")).alias(f"h{k}") for k in (1, 2, 3, 4)))


@query(f"WITH {X.SECTIONS} SELECT doc_id, pos, page_content, h1, h2, h3, h4 FROM sections")
def header_split(spark, d):
    return _flat(_place(C.header_split(_normalized(spark, d), 4)))


@query(f"WITH {X.NORM} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS BIGINT) AS pos, substr(md, s + 1, 1000) AS page_content FROM (SELECT doc_id, md, unnest(range(0, greatest(1, length(md) - 200), 800)) AS s FROM norm WHERE length(md) > 0)")
def window_chunks(spark, d):
    return _place(C.window_split(C.whole(_normalized(spark, d)), 1000, 200)).drop("headers")


@query(rf"WITH {X.NORM}, t AS (SELECT doc_id, regexp_extract_all(md, '[\p{{L}}\p{{N}}_]+') AS w FROM norm) SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS BIGINT) AS pos, array_to_string(list_slice(w, s + 1, s + 100), ' ') AS page_content FROM (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - 20), 80)) AS s FROM t WHERE len(w) > 0)")
def token_window_chunks(spark, d):
    return _place(C.token_split(C.whole(_normalized(spark, d)), 100, 20)).drop("headers")


@query()
def recursive_split(spark, d):
    return _place(C.recursive_split(C.whole(_normalized(spark, d)), 1000, 200)).drop("headers")


@query()
def semantic_split(spark, d):
    return _place(C.semantic_split(C.whole(_normalized(spark, d)), 1000)).drop("headers")


def _file(doc="doc_id"):
    return F.concat(F.lit("out/doc_"), F.col(doc), F.lit(".md"))


@query()
def chunk_pipeline(spark, d):
    rows = C.split_chain(_normalized(spark, d), splitter_chain("recursive", True, 4, 1000, 200))
    return _flat(C.chunk_metadata(rows, _file()))


def _chunks(spark, d) -> DataFrame:
    return C.chunk_metadata(C.window_split(C.header_split(_normalized(spark, d), 4), 1000, 200), _file())


@query(f"WITH {X.CHUNKS} SELECT doc_id, filename, chunk_idx, CAST(length(page_content) AS INTEGER) AS n_tokens, page_content, h1, h2, h3, h4 FROM chunks")
def chunk_metadata(spark, d):
    return _flat(_chunks(spark, d))


@query(f"WITH {X.CHUNKS} SELECT filename, min(chunk_idx) AS first, max(chunk_idx) AS last FROM chunks GROUP BY 1")
def chunk_index(spark, d):
    return C.chunk_range(_chunks(spark, d))


@query(f"WITH {X.CHUNKS} SELECT 'out/doc_' || d.doc_id || '.md' AS filename, count(c.filename) AS n_chunks FROM documents d LEFT JOIN chunks c ON c.doc_id = d.doc_id GROUP BY 1")
def chunks_per_doc(spark, d):
    return M.chunks_per_file(X.table(spark, d, "documents").select(_file().alias("filename")), _chunks(spark, d))


# ---- metadata

_ROWS = "SELECT 'doc_' || (doc_id - doc_id % 3) || '.md' AS filename, doc_id AS position, quality FROM labels"


def _label_rows(spark, d):
    return X.table(spark, d, "labels").select(F.concat(F.lit("doc_"), F.col("doc_id") - F.col("doc_id") % 3, F.lit(".md")).alias("filename"), F.col("doc_id").alias("position"), "quality")


def _doc_files(spark, d):
    return X.table(spark, d, "documents").select(F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".md")).alias("filename"))


_FILES = "SELECT 'doc_' || doc_id || '.md' AS filename FROM documents"


@query(f"WITH m AS (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY position) AS rn FROM ({_ROWS})) SELECT f.filename, m.position, m.quality FROM ({_FILES}) f LEFT JOIN m ON f.filename = m.filename AND m.rn = 1")
def prev_metadata_lookup(spark, d):
    return M.previous_metadata(_doc_files(spark, d), _label_rows(spark, d), "position")


@query(f"WITH o AS ({_ROWS}), n AS (SELECT filename, CAST(-1 AS BIGINT) AS position, CAST(9 AS INTEGER) AS quality FROM ({_FILES})) SELECT * FROM o WHERE filename NOT IN (SELECT filename FROM n) UNION ALL SELECT * FROM n")
def metadata_upsert(spark, d):
    new = _doc_files(spark, d).withColumn("position", F.lit(-1).cast("long")).withColumn("quality", F.lit(9))
    return M.metadata_upsert(_label_rows(spark, d).withColumn("quality", F.col("quality").cast("int")), new)


@query(f"SELECT filename FROM ({_FILES}) WHERE filename NOT IN (SELECT filename FROM ({_ROWS}))")
def incremental_worklist(spark, d):
    return M.worklist(_doc_files(spark, d), _label_rows(spark, d))


@query("SELECT count_if(quality = 1) AS n_ok, count(*) - count_if(quality = 1) AS n_failed FROM labels")
def etl_status_counts(spark, d):
    return M.status_counts(X.table(spark, d, "labels"), F.col("quality") == 1)


@query("SELECT 'doc_' || conv_id || '.pdf' AS filename, 'in/doc_' || conv_id || '.pdf' AS filepath, 'out/doc_' || conv_id || '.md' AS md_filepath, max(turn) + 1 AS n_pages, 'out/doc_' || conv_id || '_images' AS image_folder, 'org_model' AS model FROM conversations GROUP BY conv_id")
def doc_metadata(spark, d):
    pages = X.table(spark, d, "conversations").select(F.concat(F.lit("doc_"), F.col("conv_id"), F.lit(".pdf")).alias("filename"), (F.col("turn") + 1).alias("page"))
    return M.document_metadata(pages, "in", "out", "org/model")


# ---- index

_SNAP = f"{X.CHUNKS}, base AS (SELECT doc_id, filename, chunk_idx, page_content FROM chunks), incoming AS (SELECT doc_id, filename, chunk_idx, 'new ' || page_content AS page_content FROM chunks WHERE doc_id IN (SELECT doc_id FROM labels)), work AS (SELECT DISTINCT filename FROM incoming UNION SELECT 'out/doc_1.md')"


def _snapshots(spark, d):
    c = _chunks(spark, d).select("doc_id", "filename", "chunk_idx", "page_content")
    incoming = c.join(X.table(spark, d, "labels"), "doc_id", "left_semi").withColumn("page_content", F.concat(F.lit("new "), F.col("page_content")))
    work = incoming.select("filename").distinct().unionByName(spark.createDataFrame([("out/doc_1.md",)], "filename string"))
    return c, incoming, work


@query(f"WITH {_SNAP} SELECT * FROM base UNION ALL SELECT * FROM incoming")
def index_add(spark, d):
    base, incoming, _ = _snapshots(spark, d)
    return I.add_rows(base, incoming)


@query(f"WITH {_SNAP} SELECT * FROM base WHERE filename NOT IN (SELECT filename FROM work)")
def index_delete(spark, d):
    base, _, work = _snapshots(spark, d)
    return I.delete_files(base, work).select(*base.columns)


@query(f"WITH {_SNAP} SELECT filename, count(*) AS removed FROM base WHERE filename IN (SELECT filename FROM work) GROUP BY 1")
def index_delete_count(spark, d):
    base, _, work = _snapshots(spark, d)
    return I.deleted_counts(base, work)


@query(f"WITH {_SNAP} SELECT * FROM base WHERE filename NOT IN (SELECT filename FROM work) UNION ALL SELECT * FROM incoming")
def index_upsert(spark, d):
    base, incoming, work = _snapshots(spark, d)
    return I.upsert_files(base, work, incoming).select(*base.columns)


@query(f"WITH {_SNAP} SELECT count(*) AS n FROM base")
def index_size(spark, d):
    return I.index_size(_snapshots(spark, d)[0])


@query("""WITH o AS (SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'cosine' ELSE 'l2' END AS distance, 'm' AS model, 'flat' AS t FROM nation),
n AS (SELECT n_name AS name, 'cosine' AS distance, 'm' AS model, 'hybrid' AS t FROM (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name LIKE 'A%' UNION ALL SELECT r_name FROM region))
SELECT n.name, n.distance, n.model, CASE WHEN o.distance = n.distance THEN o.t || ',' || n.t ELSE n.t END AS types FROM n LEFT JOIN o USING (name)
UNION ALL SELECT name, distance, model, t FROM o WHERE name NOT IN (SELECT name FROM n)""")
def registry_merge(spark, d):
    n = X.table(spark, d, "nation")
    row = lambda dist, t: (F.col("n_name").alias("name"), dist.alias("distance"), F.lit("m").alias("model"), F.array(F.lit(t)).alias("types"))
    region = X.table(spark, d, "region")
    old = n.select(*row(F.when(F.col("n_nationkey") % 2 == 0, "cosine").otherwise("l2"), "flat"))
    names = n.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_name like 'A%'").select("n_name").unionByName(region.select(F.col("r_name").alias("n_name")))
    return I.registry_merge(old, names.select(*row(F.lit("cosine"), "hybrid"))).withColumn("types", F.array_join("types", ","))


@query("SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))), 6)) AS v FROM embeddings")
def l2_normalize(spark, d):
    digits = lambda x: F.when(F.round(x, 6) == 0, x * 0.0).otherwise(F.round(x, 6))  # noqa: E731 - Spark's round() loses the sign of a zero
    return X.table(spark, d, "embeddings").select("vec_id", F.transform(I.l2_normalize(F.col("embedding")), digits).alias("v"))


def _sql_knn(score: str, order: str) -> str:
    return f"""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT a.vec_id AS query_id, b.vec_id, round({score}, 6) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score {order}, vec_id) AS INTEGER) AS rank FROM s) SELECT query_id, vec_id, score, rank FROM r WHERE rank <= 5"""


@query(_sql_knn("list_cosine_similarity(a.e, b.e)", "DESC"))
def knn_cosine(spark, d):
    v = X.table(spark, d, "embeddings")
    return I.knn(v, v.where("vec_id % 100 = 0"), 5)


@query(_sql_knn("list_distance(a.e, b.e)", "ASC"))
def knn_l2(spark, d):
    v = X.table(spark, d, "embeddings")
    return I.knn(v, v.where("vec_id % 100 = 0"), 5, "l2")


_POSTS = r"""w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
posts AS (SELECT doc_id, term, CAST(dl AS INTEGER) AS dl, count(*) AS tf FROM (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM w) GROUP BY 1, 2, 3)"""
_BM25 = rf"""{_POSTS}, q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM posts GROUP BY 1), st AS (SELECT count(*) AS n, avg(len(w)) AS al FROM w),
sc AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / al))), 6) AS score FROM posts JOIN q USING (term) JOIN df USING (term), st GROUP BY 1, 2),
bm AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM sc)"""


def _bm25(spark, d, k):
    docs = X.table(spark, d, "documents")
    q = X.table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.explode(I.words("text")).alias("term"))
    return I.bm25_documents(docs, q, k)


@query(f"WITH {_POSTS} SELECT * FROM posts")
def bm25_postings(spark, d):
    return I.postings(X.table(spark, d, "documents"))


@query(f"WITH {_BM25} SELECT query_id, doc_id, score, rank FROM bm WHERE rank <= 10")
def bm25_search(spark, d):
    return _bm25(spark, d, 10)


@query(f"""WITH {_BM25}, v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT a.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
dense AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s),
b AS (SELECT query_id, id, rank FROM dense WHERE rank <= 20 UNION ALL SELECT query_id, doc_id, rank FROM bm WHERE rank <= 20),
f AS (SELECT query_id, id, round(sum(1.0 / (60 + rank)), 9) AS score FROM b GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM f) WHERE rank <= 10""")
def hybrid_rrf(spark, d):
    v = X.table(spark, d, "embeddings")
    dense = I.knn(v, v.where("vec_id % 100 = 0"), 20).withColumnRenamed("vec_id", "id")
    return I.fuse(dense, _bm25(spark, d, 20).withColumnRenamed("doc_id", "id"), 10)


@query()
def hash_embed(spark, d):
    return X.table(spark, d, "documents").select("doc_id", C.hash_embed("text").alias("embedding"))
