"""Derived inputs that make the operators do something: augmented Markdown, rectangles, index snapshots.

Each exists as a Spark plan and as SQL for DuckDB, from the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PAGE = (0.0, 0.0, 612.0, 792.0)
TOL = 8.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def augmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, md): every line rewritten by (line number + doc_id) mod 14."""
    line = r"""transform(split(text, '\\n', -1), (l, ln) -> CASE cast((ln + doc_id) % 14 AS int)
      WHEN 0 THEN concat(repeat('#', cast(1 + ((ln + doc_id) div 14) % 4 AS int)), ' ', l)
      WHEN 1 THEN concat('\n', 'Figure ', ln, '. ', l)
      WHEN 2 THEN replace(l, ' e', ' \t e')
      WHEN 3 THEN concat(l, ' [....]')
      WHEN 4 THEN concat('```\n', '# inside fence\n', l, '\n```')
      WHEN 5 THEN concat('---\n', l)
      WHEN 6 THEN concat(l, '\r')
      WHEN 7 THEN concat('\n\n\n', l)
      WHEN 8 THEN replace(l, 'er', 'e­r')
      WHEN 9 THEN concat('hyphen-\nated ', l)
      WHEN 10 THEN concat('mot‐\nuni ', l)
      WHEN 11 THEN concat('  ', l, '  ')
      ELSE l END)"""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.expr(line), "\n").alias("md"))


AUG = r"""aug AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l, j: CASE (j - 1 + doc_id) % 14
  WHEN 0 THEN repeat('#', CAST(1 + ((j - 1 + doc_id) // 14) % 4 AS INTEGER)) || ' ' || l
  WHEN 1 THEN chr(10) || 'Figure ' || (j - 1) || '. ' || l
  WHEN 2 THEN replace(l, ' e', ' ' || chr(9) || ' e')
  WHEN 3 THEN l || ' [....]'
  WHEN 4 THEN '```' || chr(10) || '# inside fence' || chr(10) || l || chr(10) || '```'
  WHEN 5 THEN '---' || chr(10) || l
  WHEN 6 THEN l || chr(13)
  WHEN 7 THEN chr(10) || chr(10) || chr(10) || l
  WHEN 8 THEN replace(l, 'er', 'e' || chr(173) || 'r')
  WHEN 9 THEN 'hyphen-' || chr(10) || 'ated ' || l
  WHEN 10 THEN 'mot' || chr(8208) || chr(10) || 'uni ' || l
  WHEN 11 THEN '  ' || l || '  '
  ELSE l END), chr(10)) AS md FROM documents)"""

SPACE = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{SPACE}+|{SPACE}+\z', '', 'g')"


SQL_STEPS = {
    "drop_ellipsis_lines": lambda x: rf"array_to_string(list_filter(string_split({x}, chr(10)), lambda l: NOT regexp_matches(l, '\[\.+\]')), chr(10))",
    "eol_unify": lambda x: f"replace({x}, chr(13) || chr(10), chr(10))",
    "collapse_ws": lambda x: rf"regexp_replace({x}, '[ \t]+', ' ', 'g')",
    "limit_newlines": lambda x: rf"regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g')",
    "drop_soft_hyphen": lambda x: f"replace({x}, chr(173), '')",
    "dehyphenate": lambda x: rf"regexp_replace({x}, '([\p{{L}}\p{{N}}_])[-\x{{2010}}\x{{2011}}\x{{2212}}]\n([\p{{L}}\p{{N}}_])', '\1\2', 'g')",
}


def sql_normalize(x: str) -> str:
    for step in SQL_STEPS.values():
        x = step(x)
    return sql_strip(x)


NORM = f"{AUG}, norm AS (SELECT doc_id, {sql_normalize('md')} AS md FROM aug)"
LINES = rf"""{NORM}, raw AS (SELECT doc_id, length(md) AS size, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) - 1 AS ln FROM norm),
lines AS (SELECT doc_id, CAST(ln AS INTEGER) AS ln, line, size,
  CAST(coalesce(sum(length(line) + 1) OVER w, 0) AS INTEGER) AS off,
  regexp_replace(line, '[ \t]+', '', 'g') = '' AS blank,
  CAST(coalesce(sum(CASE WHEN starts_with(line, '```') THEN 1 ELSE 0 END) OVER w, 0) AS INTEGER) AS nf
  FROM raw WINDOW w AS (PARTITION BY doc_id ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
_H = ", ".join(f"sum(CASE WHEN lvl > 0 AND lvl < {k} THEN 1 ELSE 0 END) OVER r AS c{k}" for k in (1, 2, 3, 4))
_L = ", ".join(f"last_value(CASE WHEN lvl = {k} THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id, c{k} ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS h{k}" for k in (1, 2, 3, 4))
HEADERS = rf"""{LINES}, lv AS (SELECT *, CASE WHEN nf % 2 = 0 AND regexp_matches(trim(line), '^#{{1,4}}( |$)') THEN length(regexp_extract(trim(line), '^(#+)', 1)) ELSE 0 END AS lvl,
  trim(regexp_replace(trim(line), '^#+', '')) AS title FROM lines),
cs AS (SELECT *, CAST(sum(CASE WHEN lvl > 0 THEN 1 ELSE 0 END) OVER r AS BIGINT) AS sec, {_H} FROM lv WINDOW r AS (PARTITION BY doc_id ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
hd AS (SELECT doc_id, ln, lvl, sec, line, {_L} FROM cs)"""
SECTIONS = rf"""{HEADERS}, sections AS (SELECT doc_id, sec AS pos, h1, h2, h3, h4, regexp_replace(t, '\A([ \t]*\n)+|(\n[ \t]*)+\z', '', 'g') AS page_content
  FROM (SELECT doc_id, sec, any_value(h1) AS h1, any_value(h2) AS h2, any_value(h3) AS h3, any_value(h4) AS h4, string_agg(line, chr(10) ORDER BY ln) AS t FROM hd WHERE lvl = 0 GROUP BY doc_id, sec)
  WHERE regexp_replace(t, '[ \t\n]+', '', 'g') <> '')"""
CHUNKS = f"""{SECTIONS}, wins AS (SELECT doc_id, pos, h1, h2, h3, h4, page_content AS body, unnest(range(0, greatest(1, length(page_content) - 200), 800)) AS s FROM sections),
chunks AS (SELECT doc_id, 'out/doc_' || doc_id || '.md' AS filename, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos, s) - 1 AS INTEGER) AS chunk_idx,
  h1, h2, h3, h4, substr(body, s + 1, 1000) AS page_content FROM wins)"""


def rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, page, rid, x0, y0, x1, y1) from lineitem, eight orders a document; rid is a number that orders a page's rectangles, not all of them."""
    r = table(spark, sf_dir, "lineitem")
    d = lambda e: F.expr(e).cast("double")
    out = r.select(
        F.expr("l_orderkey div 8").alias("doc"),
        (1 + F.col("l_linenumber") % 3).cast("int").alias("page"),
        d("10 * l_quantity").alias("x0"),
        d("(37 * l_partkey) % 700").alias("y0"),
        d("10 * l_quantity + 10 + l_suppkey % 60").alias("x1"),
        d("(37 * l_partkey) % 700 + 10 + l_partkey % 50").alias("y1"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )
    w = Window.partitionBy("doc", "page").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return out.withColumn("rid", F.row_number().over(w)).select("doc", "page", "rid", "x0", "y0", "x1", "y1")


RECTS = """rects AS (SELECT l_orderkey // 8 AS doc, CAST(1 + l_linenumber % 3 AS INTEGER) AS page,
  CAST(row_number() OVER (PARTITION BY l_orderkey // 8, 1 + l_linenumber % 3 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INTEGER) AS rid,
  CAST(10 * l_quantity AS DOUBLE) AS x0, CAST((37 * l_partkey) % 700 AS DOUBLE) AS y0,
  CAST(10 * l_quantity + 10 + l_suppkey % 60 AS DOUBLE) AS x1, CAST((37 * l_partkey) % 700 + 10 + l_partkey % 50 AS DOUBLE) AS y1 FROM lineitem)"""
SQL_TOUCH = f"a.doc = b.doc AND a.page = b.page AND a.x1 + {TOL} >= b.x0 AND b.x1 + {TOL} >= a.x0 AND a.y1 + {TOL} >= b.y0 AND b.y1 + {TOL} >= a.y0"


def sql_merged() -> str:
    out = [RECTS, "m0 AS MATERIALIZED (SELECT DISTINCT doc, page, x0, y0, x1, y1 FROM rects)"]
    for k in range(6):
        out.append(f"m{k + 1} AS MATERIALIZED (SELECT DISTINCT doc, page, x0, y0, x1, y1 FROM (SELECT a.doc, a.page, min(b.x0) AS x0, min(b.y0) AS y0, max(b.x1) AS x1, max(b.y1) AS y1 FROM m{k} a JOIN m{k} b ON {SQL_TOUCH} GROUP BY a.doc, a.page, a.x0, a.y0, a.x1, a.y1))")
    return ", ".join([*out, "merged AS (SELECT * FROM m6)"])


FIGURES = f"""{sql_merged()}, figs AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc, page ORDER BY y0, x0, y1, x1) AS INTEGER) AS k FROM merged),
cat AS (SELECT doc, printf('FIG_%03d_%02d', page, k) AS id, page, greatest(x0 - 16, 0.0) AS x0, greatest(y0 - 16, 0.0) AS y0, least(x1 + 16, 612.0) AS x1, least(y1 + 16, 792.0) AS y1 FROM figs)"""
