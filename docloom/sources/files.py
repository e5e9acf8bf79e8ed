"""File listings, format predicates, whole-text readers and sinks."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import html_to_markdown, stem

SUPPORTED = ("pdf", "xps", "epub", "mobi", "fb2", "cbz", "svg", "txt")
CATALOG = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "imagepath", "filepath")] + [T.StructField("page", T.IntegerType()), T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("caption", T.StringType())])


def scan_folder(spark: SparkSession, path: str, suffix: str = "*") -> DataFrame:
    """(path, modificationTime, length, content), not recursive."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(path)


def allowed_names(names: DataFrame, extensions: list[str], name: str = "name") -> DataFrame:
    """Names that end with an extension, once for each that matches, whatever their case."""
    each = F.explode(F.array(*(F.lit(e.lower()) for e in extensions)))
    return names.withColumn("ext", each).where(F.endswith(F.lower(name), F.col("ext")))


def extension(name: Column, fold: bool = True) -> Column:
    """Text after the last dot, the whole name without one; lower-cased unless fold is off."""
    out = F.element_at(F.split(name, r"\."), -1)
    return F.lower(out) if fold else out


def accepted(name: Column, allowed: list[str]) -> Column:
    e = extension(name)
    return e.isin(*SUPPORTED) & e.isin(*(a.lower() for a in allowed))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("md"), F.input_file_name().alias("filepath"))


def decode(files: DataFrame, decoder: Callable | None = None) -> DataFrame:
    """(filepath, page, md) of each file: decoder maps bytes to a list of pages, by default UTF-8 text or HTML in one page.

    A decoder that fails loses its own file only: that row has a null page and the error as md.
    """
    if decoder is None:
        text = F.decode("content", "UTF-8")
        return files.select(F.col("path").alias("filepath"), F.lit(1).alias("page"), F.when(F.lower("path").rlike(r"\.html?$"), html_to_markdown(text)).otherwise(text).alias("md"))

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows += [(path, k, md) for k, md in enumerate(decoder(content), 1)]
                except Exception as e:  # noqa: BLE001  the boundary to foreign decoders
                    rows.append((path, None, repr(e)))
            yield pd.DataFrame(rows, columns=["filepath", "page", "md"]).astype({"page": "Int32"})

    return files.select("path", "content").mapInPandas(run, "filepath string, page int, md string")


def image_blocks(pages: DataFrame, blocks: str = "blocks") -> DataFrame:
    """One row for each image block (type 1) that has a box; the other columns stay."""
    good = F.filter(blocks, lambda b: (b["type"] == 1) & b["bbox"].isNotNull())
    return pages.withColumn("block", F.explode(good)).drop(blocks)


def catalog_json(catalog: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, json): each document's catalog as a JSON list by page and id, nulls omitted."""
    entry = F.struct("page", "id", F.struct(*(F.col(f) for f in CATALOG.names)).alias("e"))
    rows = catalog.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("l"))
    return rows.select(key, F.to_json(F.transform("l", lambda x: x["e"])).alias("json"))


def catalog_load(stored: DataFrame, key: str = "doc_id") -> DataFrame:
    """Catalog entries of (key, json); a list or one object; malformed JSON raises."""
    text = F.when(F.startswith(F.trim("json"), F.lit("[")), F.col("json")).otherwise(F.concat(F.lit("["), F.col("json"), F.lit("]")))
    return stored.select(key, F.explode(F.from_json(text, T.ArrayType(CATALOG), {"mode": "FAILFAST"})).alias("e")).select(key, "e.*")


def load_catalogs(spark: SparkSession, path: str) -> DataFrame:
    """Catalog entries of the JSON files at path (a folder or glob), each by its file as doc_id."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc_id"), F.col("value").alias("json"))
    return catalog_load(text)


def catalogs(docs: DataFrame, stored: DataFrame, extract: Callable[[DataFrame], DataFrame] | None = None, key: str = "doc_id") -> DataFrame:
    """Catalog entries of docs: those stored as (key, json), and what `extract` makes of the documents that have none.

    Without extract, a document without a stored catalog raises when its row is read.
    """
    missing = docs.join(stored.select(key).distinct(), key, "left_anti")
    cached = catalog_load(stored.join(docs.select(key).distinct(), key, "left_semi"), key)
    if extract is not None:
        return cached.unionByName(extract(missing).select(*cached.columns))
    lost = missing.select(key, F.raise_error(F.concat(F.lit("no catalog of "), F.col(key).cast("string"))).cast("string").alias("id"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in CATALOG.fields[1:]))
    return cached.unionByName(lost)


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """Write each row's content (text as UTF-8, or bytes) to the file folder/name, from the tasks; (name, n_bytes) of what is there.

    folder is a path or URI that all executors share. A file is written beside its place and then moved there, so
    that readers see whole files, and a task that runs again writes the same. Rows of one name overwrite
    each other in no order; a null content writes nothing. Files are written when the result is computed.
    """

    def run(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        made: set[str] = set()
        for batch in batches:
            done = []
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if c is None:
                    continue
                data = c.encode() if isinstance(c, str) else bytes(c)
                path = f"{root.rstrip('/')}/{n}"
                parent = path.rsplit("/", 1)[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                part = f"{parent}/.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(data)
                store.move(part, path)
                done.append((n, len(data)))
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["name", "n_bytes"])

    return rows.select(F.col(name).alias("name"), F.col(content).alias("content")).mapInArrow(run, "name string, n_bytes long")


def _written(done: DataFrame) -> int:
    return done.agg(F.count("*")).first()[0]


def write_markdown(docs: DataFrame, folder: str) -> int:
    """Write docs (filename, md) as <base>.md, overwriting; the number of files."""
    return _written(write_files(docs.select(F.concat(stem(F.col("filename")), F.lit(".md")).alias("name"), "md"), folder, content="md"))


def write_catalogs(catalog: DataFrame, folder: str, key: str = "doc_id") -> int:
    """Write each document's catalog as <key>.json: a list in order of page and id, indented by 2, nulls omitted; the number of files."""

    @F.pandas_udf("string")
    def indented(s: pd.Series) -> pd.Series:
        return s.map(lambda x: json.dumps(json.loads(x), ensure_ascii=False, indent=2))

    rows = catalog_json(catalog, key).select(F.concat(F.col(key).cast("string"), F.lit(".json")).alias("name"), indented("json").alias("json"))
    return _written(write_files(rows, folder, content="json"))


def metadata_path(folder: str, model: str) -> str:
    """Where the documents' metadata for an embedding model are."""
    return f"{folder.rstrip('/')}/documents_metadata_{model.replace('/', '_')}.json"


def write_metadata(meta: DataFrame, folder: str, model: str) -> str:
    """Write metadata rows as JSON lines, nulls omitted, to a folder of that name, so that no task has them all; its path."""
    path = metadata_path(folder, model)
    meta.write.mode("overwrite").json(path)
    return path


def render_sizes(catalog: DataFrame, dpi: float) -> DataFrame:
    """catalog with width and height in pixels of each box (in points, 72 an inch) at that resolution."""
    px = lambda a, b: F.ceil((F.element_at("bbox", b) - F.element_at("bbox", a)) * dpi / 72).cast("int")
    return catalog.withColumns({"width": px(1, 3), "height": px(2, 4)})


def write_figures(catalog: DataFrame, render: Callable[[str, int, list[float], float], bytes], folder: str, dpi: float = 200) -> int:
    """Write the image that render(filepath, page, bbox, dpi) gives of each entry to folder/imagepath; the number of files.

    render runs in the tasks; what it raises fails the job. Rendering itself is the caller's: no decoder comes with this package.
    """

    @F.pandas_udf("binary")
    def image(path: pd.Series, page: pd.Series, box: pd.Series) -> pd.Series:
        return pd.Series([render(f, int(p), list(b), dpi) for f, p, b in zip(path, page, box)])

    return _written(write_files(catalog.select(F.col("imagepath").alias("name"), image("filepath", "page", "bbox").alias("png")), folder, content="png"))
