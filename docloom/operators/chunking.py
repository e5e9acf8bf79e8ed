"""Splitters and their chain. Every stage takes and returns rows of (doc_id, pos, headers, page_content).

pos is an array: the place in the document, then the place in the piece of the stage before, and so on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from ..functions.lines import each_document, each_text, find_sections
from ..functions.text import WORD


def header_split(docs: DataFrame, levels: int = 2) -> DataFrame:
    """(doc_id, pos, headers, page_content) of docs (doc_id, md): the runs between headers, which leave the text.

    Blank lines at both ends go, empty sections are dropped, headers in fences are text. pos is [section].
    """
    names = [f"h{k}" for k in range(1, levels + 1)]
    found = each_document(docs, ["md"], lambda md: find_sections(md, levels), f"sec int, {', '.join(f'{n} string' for n in names)}, page_content string")
    headers = F.map_filter(F.map_from_arrays(F.array(*(F.lit(f"Header {k}") for k in range(1, levels + 1))), F.array(*names)), lambda k, v: v.isNotNull())
    return found.select("doc_id", F.array("sec").alias("pos"), headers.alias("headers"), "page_content")


def _spread(rows: DataFrame, pieces: Column) -> DataFrame:
    """The pieces of each row; the place of a piece follows that of its row, so that order holds at any number of pieces."""
    out = rows.select("doc_id", "pos", "headers", F.posexplode(pieces).alias("k", "page_content"))
    return out.select("doc_id", F.concat("pos", F.array("k")).alias("pos"), "headers", "page_content")


def window_split(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """Windows of size characters, each starting size - overlap after the last."""
    step, n = _step(size, overlap), F.length("page_content")
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), n - overlap - 1), F.lit(step))).otherwise(F.array().cast("array<int>"))
    return _spread(rows, F.transform(starts, lambda i: F.substring(F.col("page_content"), i + 1, F.lit(size))))


def token_split(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """The same over word tokens, joined by single spaces."""
    step = _step(size, overlap)
    rows = rows.withColumn("_w", F.regexp_extract_all("page_content", F.lit(f"{WORD}+"), F.lit(0)))
    n = F.size("_w")
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), n - overlap - 1), F.lit(step))).otherwise(F.array().cast("array<int>"))
    return _spread(rows, F.transform(starts, lambda i: F.array_join(F.slice("_w", i + 1, F.lit(size)), " ")))


def _step(size: int, overlap: int) -> int:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the size")
    return size - overlap


def recursive_pieces(text: str, size: int, overlap: int, separators: tuple[str, ...] = ("\n\n", "\n", " ", "")) -> list[str]:
    """Chunks of at most size characters, cut at the coarsest separators that serve.

    Pieces are packed greedily; a chunk starts with the longest tail of whole pieces of the last one
    whose length is at most the overlap. Chunks are stripped, empty ones dropped.
    """
    parts: list[str] = []

    def cut(t: str, seps: tuple[str, ...]) -> None:
        if len(t) <= size:
            parts.append(t)
        elif not seps or seps[0] == "":
            parts.extend(t[i : i + size] for i in range(0, len(t), size))
        else:
            for p in re.findall(rf"(?s).*?{re.escape(seps[0])}|.+\Z", t):
                cut(p, seps[1:])

    cut(text, separators)
    out: list[str] = []
    held: list[str] = []
    n = 0
    for p in parts:
        if held and n + len(p) > size:
            out.append("".join(held))
            while held and (n > overlap or n + len(p) > size):
                n -= len(held.pop(0))
        held.append(p)
        n += len(p)
    out.append("".join(held))
    return [c for c in (x.strip() for x in out) if c]


def recursive_split(rows: DataFrame, size: int = 1000, overlap: int = 150) -> DataFrame:
    _step(size, overlap)

    pieces = each_text(lambda t: recursive_pieces(t, size, overlap), ArrayType(StringType()))
    return _spread(rows, pieces("page_content"))


def hash_embed_values(text: str, dim: int = 64) -> list[float]:
    """A deterministic stand-in for an embedding model: signed hashed words, of unit length."""
    import zlib

    v = np.zeros(dim)
    for w in re.findall(r"\w+", (text or "").lower()):
        h = zlib.crc32(w.encode())
        v[h % dim] += 1 if h >> 31 else -1
    n = np.linalg.norm(v)
    return (v / n if n else v).tolist()


def embedder(model: Callable[[], Callable[[list[str]], list[list[float]]]]) -> Callable[[Column | str], Column]:
    """A column function for an embedding model: model() loads it once for each worker, and it is called by batches of texts.

    A null text is embedded like an empty one.
    """

    @F.pandas_udf(ArrayType(DoubleType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = model()
        for s in batches:
            yield pd.Series([list(map(float, v)) for v in run([x or "" for x in s])])

    return embed


hash_embed = embedder(lambda: lambda texts: [hash_embed_values(t) for t in texts])


def semantic_pieces(text: str, size: int, embed: Callable[[str], list[float]], percentile: float = 95) -> list[str]:
    """Sentences joined up to where neighbours' cosine distance exceeds the text's percentile, past size / 3 characters."""
    sents = re.findall(r"(?s).+?(?:[.!?]+\s+|\Z)", text)
    if len(sents) < 2:
        return [text.strip()] if text.strip() else []
    v = np.array([embed(s) for s in sents])
    far = 1 - (v[1:] * v[:-1]).sum(1)
    limit, out, run = np.percentile(far, percentile), [], sents[0]
    for s, d in zip(sents[1:], far):
        if d > limit and len(run) >= size // 3:
            out.append(run)
            run = s
        else:
            run += s
    return [c for c in (x.strip() for x in [*out, run]) if c]


def semantic_split(rows: DataFrame, size: int = 1000, embed: Callable[[str], list[float]] = hash_embed_values) -> DataFrame:
    pieces = each_text(lambda t: semantic_pieces(t, size, embed), ArrayType(StringType()))
    return _spread(rows, pieces("page_content"))


def whole(docs: DataFrame) -> DataFrame:
    """Documents as one chunk each, for chains that don't start with the header splitter."""
    return docs.select("doc_id", F.array(F.lit(0)).alias("pos"), F.create_map().cast("map<string,string>").alias("headers"), F.col("md").alias("page_content"))


#: Splitters by name: f(rows, stage) -> rows. register_splitter() adds to them.
SPLITTERS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {
    "recursive": lambda rows, s: recursive_split(rows, s.get("chunk_size", 1000), s.get("chunk_overlap", 150)),
    "window": lambda rows, s: window_split(rows, s.get("chunk_size", 1000), s.get("chunk_overlap", 150)),
    "sentence": lambda rows, s: token_split(rows, s.get("chunk_size", 1000), s.get("chunk_overlap", 150)),
    "semantic": lambda rows, s: semantic_split(rows, s.get("chunk_size", 1000), s.get("embed", hash_embed_values)),
}


def register_splitter(name: str, split: Callable[[DataFrame, dict], DataFrame]) -> None:
    """Make a splitter known to chains and configurations; it gets rows and the stage's settings."""
    if name == "markdown" or name in SPLITTERS:
        raise ValueError(f"there is a splitter {name!r} already")
    SPLITTERS[name] = split


def split_chain(docs: DataFrame, stages: list[dict]) -> DataFrame:
    """Apply the stages of config.splitter_chain() in order; without stages there are no chunks."""
    rows = whole(docs)
    if not stages:
        return rows.limit(0)
    for k, s in enumerate(stages):
        kind = s["splitter"]
        if kind == "markdown":
            if k:
                raise ValueError("the header splitter can only be the first")
            rows = header_split(docs, s.get("header_levels", 2))
        elif kind in SPLITTERS:
            rows = SPLITTERS[kind](rows, s)
        else:
            raise ValueError(f"unknown splitter {kind!r}")
    return rows


def chunk_metadata(rows: DataFrame, filename: Column, counted: bool = True) -> DataFrame:
    """(doc_id, filename, chunk_idx, headers, n_tokens, page_content): numbered from 0 in document order.

    n_tokens counts characters, as the splitters' length function does; if the chain has no splitter with one
    (counted is off), it is 0.
    """
    w = Window.partitionBy("doc_id").orderBy("pos")
    n = F.length("page_content") if counted else F.lit(0)
    return rows.select("doc_id", filename.alias("filename"), (F.row_number().over(w) - 1).alias("chunk_idx"), "headers", n.alias("n_tokens"), "page_content")


def chunk_range(chunks: DataFrame) -> DataFrame:
    """(filename, first, last): the chunk numbers of each file."""
    return chunks.groupBy("filename").agg(F.min("chunk_idx").alias("first"), F.max("chunk_idx").alias("last"))
