"""Lines of Markdown: captions, content breaks and headers, each found in one pass over a document in place.

No document is exploded and gathered again: plain functions work on one text, and the DataFrame forms apply
them to Arrow batches without an exchange. A null text has no lines, spots, headers or break.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType

FENCE = "```"
#: Arrow batches are worked on in pieces of so many bytes, unless one row alone has more.
PIECE = 1 << 20
_HEADER, _RULE = re.compile(r"\s{0,3}#{1,6}(?:\s|$)"), re.compile(r"(?:-{3,}|\*{3,}|_{3,})\s*$")


def split_lines(md: str, start: int = 0) -> Iterator[tuple[int, int, bool]]:
    """(start, end, inside) of each line from `start` on, which counts as a line's start; inside a fence opened since then."""
    inside = False
    while True:
        end = md.find("\n", start)
        stop = len(md) if end < 0 else end
        yield start, stop, inside
        inside ^= md.startswith(FENCE, start, stop)
        if end < 0:
            return
        start = end + 1


def find_break(md: str, start: int = 0) -> int:
    """The first place at or after `start`, outside of a fence opened since, where content may be put; `start` if there is none.

    That is the least of: the end of a header line; behind a rule and the blank lines that follow it; the end
    of the line before a blank line. A rule or blank line needs a line before it, a blank line one after it.
    """
    if start > len(md):
        return start
    best = behind = None  # behind: a rule whose blank lines have not ended
    for k, (a, b, inside) in enumerate(split_lines(md, start)):
        blank = not md[a:b].strip()
        if behind is not None and not blank:
            best, behind = min(a, best if best is not None else a), None
        if best is not None and best < a:
            break
        if inside:
            continue
        if blank and k and b < len(md):
            at = a - 1
        elif _HEADER.match(md, a, b):
            at = b
        else:
            if k and behind is None and _RULE.match(md, a, b):
                behind = a
            continue
        best = at if best is None else min(at, best)
    if best is None and behind is not None:
        best = len(md)
    return start if best is None else best


def find_captions(md: str, keywords: Iterable[str], start: int = 0, stop: int | None = None) -> list[int]:
    """Starts of the blank lines in md[start:stop] directly followed by a line that starts with a keyword as a word."""
    words = "|".join(map(re.escape, keywords))
    first, stop = max(0, start), len(md) if stop is None else stop
    out = []
    # of the line that follows, the keyword must lie within the slice
    for m in re.compile(rf"\n(?=(?:{words})\b)").finditer(md, first, stop) if words else ():
        at = md.rfind("\n", 0, m.start()) + 1
        if at >= first and not md[at : m.start()].strip(" \t"):
            out.append(at)
    return out


def find_headers(md: str, levels: int) -> Iterator[tuple[int, int, int, tuple]]:
    """(start, end, level or 0, titles of the levels in force) of each line; headers inside of fences are text."""
    path: list[str | None] = [None] * levels
    rx = re.compile(rf"#{{1,{levels}}}(?: |$)")
    for a, b, inside in split_lines(md):
        line = md[a:b].strip(" ")
        level = 0
        if not inside and rx.match(line):
            title = line.lstrip("#")
            level = len(line) - len(title)
            path = [*path[: level - 1], title.strip(" "), *[None] * (levels - level)]
        yield a, b, level, tuple(path)


def find_sections(md: str, levels: int) -> list[tuple]:
    """(number, titles..., text) of the runs between headers, without blank lines at both ends; empty runs are left out."""
    out, number, held, path = [], 0, [], (None,) * levels
    for a, b, level, now in find_headers(md, levels):
        if level:
            out.append((number, path, held))
            number, held, path = number + 1, [], now
        else:
            held.append(md[a:b])
    out.append((number, path, held))
    solid = [(n, p, [bool(x.strip(" \t")) for x in h], h) for n, p, h in out]
    return [(n, *p, "\n".join(h[s.index(True) : len(s) - s[::-1].index(True)])) for n, p, s, h in solid if any(s)]


def pieces(batch: pa.RecordBatch | pa.Array, most: int = PIECE) -> Iterator[pa.RecordBatch | pa.Array]:
    """The batch in pieces of at most `most` bytes, so that what Python makes of its rows doesn't grow with the batch."""
    if len(batch) > 1 and batch.nbytes > most:
        half = len(batch) // 2
        yield from pieces(batch.slice(0, half), most)
        yield from pieces(batch.slice(half), most)
    else:
        yield batch


def each_text(f: Callable, kind: DataType) -> Callable[..., Column]:
    """A column function: f of each row's values, made piece by piece in an Arrow function; null where the first value is null."""
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in pieces(batch):
                columns = pa.RecordBatch.from_struct_array(part).columns
                yield pa.array([None if v[0] is None else f(*v) for v in zip(*(c.to_pylist() for c in columns))], arrow)

    made = F.arrow_udf(run, kind)
    return lambda *columns: made(F.struct(*columns))


def each_document(docs: DataFrame, columns: list[str], rows: Callable[..., Iterable[tuple]], schema: str, key: str = "doc_id") -> DataFrame:
    """The rows that `rows` makes of the columns of each document, with the key before them; schema describes rows only.

    Python holds the rows of one piece of an Arrow batch at a time, see pieces().
    """
    names = [c.split()[0] for c in re.split(r",\s*(?![^<]*>)", schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                made, owner = [], []
                for i, values in enumerate(zip(*(c.to_pylist() for c in part.columns[1:]))):
                    new = list(rows(*values)) if values[0] is not None else []
                    made += new
                    owner += [i] * len(new)
                cols = list(zip(*made)) or [()] * len(names)
                keys = part.column(0).take(pa.array(owner, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, t) for c, t in zip(cols, types))], [key, *names])

    kind = docs.schema[key].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields]
    return docs.select(key, *columns).mapInArrow(run, f"`{key}` {kind}, {schema}")


def line_table(docs: DataFrame, key: str = "doc_id", text: str = "md") -> DataFrame:
    """(key, ln, line, off, size, blank, nf): 0-based line, its 0-based offset, whether it is blank, fences before it."""

    def rows(md: str) -> Iterator[tuple]:
        nf = 0
        for ln, (a, b, _) in enumerate(split_lines(md)):
            line = md[a:b]
            yield ln, line, a, len(md), not line.strip(" \t"), nf
            nf += line.startswith(FENCE)

    return each_document(docs, [text], rows, "ln int, line string, off int, size int, blank boolean, nf int", key)


def caption_spots(docs: DataFrame, keywords: list[str], start: str | None = None, stop: str | None = None, key: str = "doc_id", text: str = "md") -> DataFrame:
    """(key, spot): the offsets of find_captions() in each document, or in its slice by the columns start and stop."""
    return caption_parts(docs, keywords, {"": (start, stop)}, key, text).drop("part")


def caption_parts(docs: DataFrame, keywords: list[str], parts: dict[str, tuple[str | None, str | None]], key: str = "doc_id", text: str = "md") -> DataFrame:
    """(key, spot, part): caption_spots() of each named slice (start, stop), in one pass over the documents."""
    ends = [F.col(c).cast("int") if c else other for a, b in parts.values() for c, other in ((a, F.lit(0)), (b, F.length(text)))]
    d = docs.select(key, text, F.array(*ends).alias("_ends"))
    rows = lambda md, e: [(x, name) for i, name in enumerate(parts) for x in find_captions(md, keywords, *e[2 * i : 2 * i + 2])]
    return each_document(d, [text, "_ends"], rows, "spot int, part string", key)


_break = each_text(find_break, IntegerType())


def content_break(md: Column, start: Column | int = 0) -> Column:
    """find_break() of a text from an offset on."""
    return _break(md, F.lit(start) if isinstance(start, int) else start)


def header_lines(docs: DataFrame, levels: int = 4, key: str = "doc_id", text: str = "md") -> DataFrame:
    """(key, ln, lvl, h1..hN) of each line: its level, 0 for text, and the titles in force."""
    names = ", ".join(f"h{k} string" for k in range(1, levels + 1))
    return each_document(docs, [text], lambda md: ((ln, lvl, *path) for ln, (_, _, lvl, path) in enumerate(find_headers(md, levels))), f"ln int, lvl int, {names}", key)
