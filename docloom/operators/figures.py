"""Page anchors, figure rectangles, and the placement of figures in Markdown."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lines import each_document, find_break, find_captions
from ..functions.text import NOT_WORD, alt_text, anchor_pattern, figure_id, page_snippet

BOX = ("x0", "y0", "x1", "y1")


def find_anchors(md: str, patterns: list[str | None]) -> list[int]:
    """Offsets of the pages' patterns, each searched on from the hit before; a miss takes that one's place.

    One less than the hit is given, so that it includes the line end.
    """
    low, out = 0, []
    for rx in patterns:
        hit = re.compile(rf"(?<!\w){rx.replace(NOT_WORD, chr(92) + 'W')}(?!\w)").search(md, low) if rx else None
        low = hit.start() if hit else low
        out.append(low - 1)
    return out


def page_anchors(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page, off): where each page's first words are found, searching on from the page before.

    docs: doc_id, md; pages: doc_id, page, text. Pages are gathered by document, then texts are searched batch
    by batch. A document with a null text, or that is not in docs, has all its pages at -1; pages of a null number come first.
    """
    rx = anchor_pattern(page_snippet(F.col("text")))
    by = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", rx.alias("rx")))).alias("pages"))
    both = by.join(docs.select("doc_id", "md"), "doc_id", "left").withColumn("md", F.coalesce("md", F.lit("")))
    return each_document(both, ["md", "pages"], lambda md, p: zip((x["page"] for x in p), find_anchors(md, [x["rx"] for x in p])), "page int, off int")


def monotone_anchors(anchors: DataFrame) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return anchors.withColumn("off", F.greatest(F.lit(0), F.max("off").over(w)))


def page_bounds(anchors: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc_id, page, start, stop); sizes: doc_id, size."""
    w = Window.partitionBy("doc_id").orderBy("page")
    return anchors.join(sizes, "doc_id").select("doc_id", "page", F.col("off").alias("start"), F.coalesce(F.lead("off").over(w), F.col("size")).alias("stop"))


def union_boxes(rects: DataFrame, *by: str) -> DataFrame:
    """(by..., x0, y0, x1, y1): the least box around the boxes of each group."""
    return rects.groupBy(*by).agg(*(F.min(c).alias(c) for c in BOX[:2]), *(F.max(c).alias(c) for c in BOX[2:]))


def touching(a: str, b: str, tol: float) -> Column:
    """Whether two boxes overlap or are at most tol apart on both axes."""
    c = F.col
    return (c(f"{a}.x1") + tol >= c(f"{b}.x0")) & (c(f"{b}.x1") + tol >= c(f"{a}.x0")) & (c(f"{a}.y1") + tol >= c(f"{b}.y0")) & (c(f"{b}.y1") + tol >= c(f"{a}.y0"))


def touch_pairs(rects: DataFrame, tol: float) -> DataFrame:
    """(doc, page, rid_a, rid_b) of touching rectangles of a page, rid_a < rid_b: an equi-join with the ranges as its condition."""
    a, b = rects.alias("a"), rects.alias("b")
    on = (F.col("a.doc") == F.col("b.doc")) & (F.col("a.page") == F.col("b.page")) & (F.col("a.rid") < F.col("b.rid")) & touching("a", "b", tol)
    return a.join(b, on).select("a.doc", "a.page", F.col("a.rid").alias("rid_a"), F.col("b.rid").alias("rid_b"))


def merge_boxes(boxes: list[tuple], tol: float) -> list[tuple]:
    """Union touching boxes until none touch; the result does not depend on the order. Comparisons are by whole columns."""
    b = np.array(boxes, float).reshape(-1, 4)
    done = np.empty_like(b)
    n = 0
    for box in b:
        while True:
            o = done[:n]
            near = (box[2] + tol >= o[:, 0]) & (o[:, 2] + tol >= box[0]) & (box[3] + tol >= o[:, 1]) & (o[:, 3] + tol >= box[1])
            if not near.any():
                break
            box = np.concatenate((np.minimum(o[near, :2].min(0), box[:2]), np.maximum(o[near, 2:].max(0), box[2:])))
            rest = o[~near]
            n = len(rest)
            done[:n] = rest
        done[n] = box
        n += 1
    return [tuple(x) for x in done[:n].tolist()]


def merge_rects(rects: DataFrame, tol: float) -> DataFrame:
    """(doc, page, x0, y0, x1, y1): distinct merged boxes of each page.

    Pages are dealt to bins, a few for each shuffle partition, so that a group costs no call of its own.
    """
    bins = 8 * int(rects.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(table: pa.Table) -> pa.Table:
        pages: dict[tuple, list[tuple]] = {}
        for doc, page, *box in zip(*(table[c].to_pylist() for c in ("doc", "page", *BOX))):
            pages.setdefault((doc, page), []).append(tuple(box))
        rows = [(*key, *b) for key, boxes in pages.items() for b in merge_boxes(boxes, tol)]
        kinds = (pa.int64(), pa.int32(), *[pa.float64()] * 4)
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("doc", "page", *BOX), zip(*rows), kinds)})

    dealt = rects.select("doc", "page", *BOX).distinct().withColumn("_bin", F.pmod(F.xxhash64("doc", "page"), F.lit(bins)))
    return dealt.groupBy("_bin").applyInArrow(run, "doc long, page int, x0 double, y0 double, x1 double, y1 double")


def pad_clip(rects: DataFrame, pad: float, page_box: tuple[float, float, float, float]) -> DataFrame:
    if pad <= 0:
        return rects
    lo = {c: F.greatest(F.col(c) - pad, F.lit(float(page_box[i]))) for i, c in enumerate(BOX[:2])}
    return rects.withColumns(lo | {c: F.least(F.col(c) + pad, F.lit(float(page_box[i + 2]))) for i, c in enumerate(BOX[2:])})


def figure_order(boxes: DataFrame) -> DataFrame:
    """boxes with k, their number on the page from 1 in reading order."""
    w = Window.partitionBy("doc", "page").orderBy("y0", "x0", "y1", "x1")
    return boxes.withColumn("k", F.row_number().over(w))


def figure_catalog(boxes: DataFrame, pad: float, page_box: tuple[float, float, float, float], folder: Column, filepath: Column) -> DataFrame:
    """(doc, id, imagepath, filepath, page, bbox, caption): numbered before padding."""
    done = pad_clip(figure_order(boxes), pad, page_box)
    fid = figure_id(F.col("page"), F.col("k"))
    return done.select("doc", fid.alias("id"), F.concat(folder, F.lit("/"), fid, F.lit(".png")).alias("imagepath"), filepath.alias("filepath"), "page", F.array(*BOX).alias("bbox"), F.lit(None).cast("string").alias("caption"))


def page_figures(catalog: DataFrame, bounds: DataFrame) -> DataFrame:
    """(doc_id, page, start, stop, ids): figures by page, top to bottom; pages without figures and figures without page are left out."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct(F.element_at("bbox", 2).alias("y"), "id"))), lambda x: x["id"])
    return catalog.groupBy("doc_id", "page").agg(ids.alias("ids")).join(bounds, ["doc_id", "page"])


def figure_caption_match(figures: DataFrame, spots: DataFrame) -> DataFrame:
    """k-th figure of a page with its k-th caption spot; figures without one have a null spot."""
    f = figures.withColumn("rn", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("y0", "id")))
    s = spots.withColumn("rn", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("spot")))
    return f.join(s, ["doc_id", "page", "rn"], "left")


def apply_insertions(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """docs (doc_id, md) with the edits (doc_id, idx, seq, txt) spliced in; offsets are of the original text.

    Edits at one offset keep their order; an offset beyond the end appends.
    """
    e = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("idx", "seq", "txt"))).alias("e"))
    size = F.length("md")
    at = lambda x: F.least(F.greatest(x["idx"], F.lit(0)), size)
    piece = F.transform("e", lambda x, i: F.concat(x["txt"], F.substring(F.col("md"), at(x) + 1, F.when(i + 1 < F.size("e"), at(F.get("e", i + 1))).otherwise(size) - at(x))))
    text = F.when(F.col("e").isNull(), F.col("md")).otherwise(F.concat(F.substring("md", F.lit(1), at(F.get("e", F.lit(0)))), F.array_join(piece, "")))
    return docs.join(e, "doc_id", "left").select("doc_id", text.alias("md"))


def image_line(caption: Column, figure: Column, path: Column) -> Column:
    """The Markdown that is inserted for a figure."""
    return F.concat(F.lit("\n\n!["), alt_text(caption, figure), F.lit("]("), path, F.lit(") <!-- "), figure, F.lit(" -->\n"))


def find_places(md: str, figures: list[dict], keywords: list[str]) -> list[tuple[int, int, str]]:
    """(offset, number, text) of the insertions of figures (page, start, stop, y0, id, txt), page by page from top to bottom.

    The caption spots of a page are used once each, in order; without one left, a figure goes to the content
    break from a cursor that starts at the page's start and moves behind what was inserted.
    """
    out, page, free, cursor = [], None, [], 0
    for f in sorted(figures, key=lambda f: (f["page"], f["y0"], f["id"])):
        if f["page"] != page:
            page, cursor = f["page"], f["start"]
            free = find_captions(md, keywords, f["start"], f["stop"])
        if free:
            at = free.pop(0)
        else:
            at = find_break(md, cursor)
            cursor = at + len(f["txt"])
        out.append((at, len(out), f["txt"]))
    return out


def place_figures(pages: DataFrame, keywords: list[str]) -> DataFrame:
    """(doc_id, idx, seq, txt): insertions of figures. pages: doc_id, md, figures array<struct<page, start, stop, y0, id, imagepath, caption>>.

    See find_places(). A document with a null text or null figures has none; an offset may lie behind the text's end.
    """
    lines = F.transform("figures", lambda x: x.withField("txt", image_line(x["caption"], x["id"], x["imagepath"])))
    d = pages.select("doc_id", "md", F.coalesce(lines, F.array()).alias("figures"))
    return each_document(d, ["md", "figures"], lambda md, f: find_places(md, f, keywords), "idx int, seq int, txt string")
