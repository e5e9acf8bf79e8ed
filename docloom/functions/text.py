"""Markdown text as column expressions, which all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 code points that count as whitespace, for Java and RE2 alike; word characters likewise.
SPACE = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SPACES = "".join(chr(c) for a, b in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for c in range(a, b + 1))
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
HYPHENATED = rf"({WORD})[-\x{{2010}}\x{{2011}}\x{{2212}}]\n({WORD})"
BREAKS = r"\r\n|[\n\x{0B}\x{0C}\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"


def drop_ellipsis_lines(md: Column) -> Column:
    return F.array_join(F.filter(F.split(md, "\n", -1), lambda x: ~x.rlike(r"\[\.+\]")), "\n")


def nfkc(md: Column) -> Column:
    """Compatibility normalisation by the ICU library that Spark ships; texts of ASCII only are their own form and are left as they are.

    ICU's tables are of Unicode 16: of single characters only those that Python 3.13 (Unicode 15.1) doesn't know come out otherwise.
    """
    other = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), md, F.lit(True))
    return F.when(md.isNull() | (F.octet_length(md) == F.length(md)), md).otherwise(other)


def eol_unify(md: Column) -> Column:
    return F.replace(md, F.lit("\r\n"), F.lit("\n"))


def collapse_ws(md: Column) -> Column:
    return F.regexp_replace(md, r"[ \t]+", " ")


def limit_newlines(md: Column) -> Column:
    return F.regexp_replace(md, r"\n{3,}", "\n\n")


def drop_soft_hyphen(md: Column) -> Column:
    return F.replace(md, F.lit("­"), F.lit(""))


def dehyphenate(md: Column) -> Column:
    return F.regexp_replace(md, HYPHENATED, "$1$2")


def strip(md: Column) -> Column:
    return F.btrim(md, F.lit(SPACES))


def normalize_markdown(md: Column, compat: bool = True) -> Column:
    """The cleaning steps in their fixed order; compat adds Unicode compatibility normalisation."""
    md = drop_ellipsis_lines(md)
    if compat:
        md = nfkc(md)
    return strip(dehyphenate(drop_soft_hyphen(limit_newlines(collapse_ws(eol_unify(md))))))


def page_snippet(text: Column, min_chars: int = 50, max_chars: int = 200) -> Column:
    """First stripped line of at least min_chars characters, cut at max_chars; else the text's start."""
    lines = F.filter(F.transform(F.split(text, BREAKS, -1), strip), lambda x: F.length(x) >= min_chars)
    return F.coalesce(F.substring(F.get(lines, F.lit(0)), 1, max_chars), strip(F.substring(text, 1, max_chars)))


def anchor_tokens(snippet: Column, most: int = 10) -> Column:
    return F.slice(F.regexp_extract_all(snippet, F.lit(rf"{WORD}+"), F.lit(0)), 1, most)


def anchor_pattern(snippet: Column, most: int = 10) -> Column:
    """A pattern of the first words with any non-words between, null without words."""
    tokens = anchor_tokens(snippet, most)
    return F.when(F.size(tokens) > 0, F.array_join(tokens, rf"{NOT_WORD}+"))


def alt_text(caption: Column, figure: Column) -> Column:
    base = F.coalesce(F.nullif(caption, F.lit("")), figure)
    clean = F.regexp_replace(strip(F.regexp_replace(strip(base), rf"{SPACE}+", " ")), r"[\[\]()]", "")
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("image"))


def figure_id(page: Column, index: Column) -> Column:
    return F.format_string("FIG_%03d_%02d", page, index)


def stem(name: Column) -> Column:
    """Name without its last extension; a leading dot starts none."""
    return F.regexp_replace(name, r"(.)\.[^.]*$", "$1")


def model_slug(model: Column) -> Column:
    return F.replace(model, F.lit("/"), F.lit("_"))


HTML_STEPS = (
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", ""),
    (r"(?is)<h1[^>]*>", "\n\n# "),
    (r"(?is)<h2[^>]*>", "\n\n## "),
    (r"(?is)<h3[^>]*>", "\n\n### "),
    (r"(?is)</?(h[1-6]|p|div|ul|ol|table|tr)[^>]*>", "\n\n"),
    (r"(?is)<li[^>]*>", "\n- "),
    (r"(?is)<br[^>]*>", "\n"),
    (r'(?is)<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', r"[\2](\1)"),
    (r"(?is)</?(b|strong)>", "**"),
    (r"(?is)<[^>]+>", ""),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"[ \t]+", " "),
    (r" ?\n ?", "\n"),
    (r"\n{3,}", "\n\n"),
)


def html_to_markdown(html: Column) -> Column:
    for pattern, to in HTML_STEPS:
        html = F.regexp_replace(html, pattern, to.replace("\\1", "$1").replace("\\2", "$2"))
    return strip(html)
