"""Document metadata: lookup, upsert, work lists and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import model_slug, stem


def output_paths(names: DataFrame, folder: str, name: str = "name") -> DataFrame:
    s = stem(F.col(name))
    return names.select(name, F.concat_ws("/", F.lit(folder), F.concat(s, F.lit(".md"))).alias("md_filepath"), F.concat_ws("/", F.lit(folder), F.concat(s, F.lit("_images"))).alias("image_folder"))


def first_by_position(meta: DataFrame, position: str) -> DataFrame:
    """The first row of each filename."""
    w = Window.partitionBy("filename").orderBy(position)
    return meta.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def previous_metadata(files: DataFrame, meta: DataFrame, position: str) -> DataFrame:
    return files.join(first_by_position(meta, position), "filename", "left")


def metadata_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.join(new.select("filename").distinct(), "filename", "left_anti").unionByName(new)


def worklist(inputs: DataFrame, outputs: DataFrame, on: str = "filename") -> DataFrame:
    """Inputs whose output does not exist yet."""
    return inputs.join(outputs.select(on).distinct(), on, "left_anti")


def status_counts(done: DataFrame, ok: Column) -> DataFrame:
    return done.agg(F.count_if(ok).alias("n_ok"), (F.count("*") - F.count_if(ok)).alias("n_failed"))


def chunks_per_file(files: DataFrame, chunks: DataFrame) -> DataFrame:
    n = chunks.groupBy("filename").agg(F.count("*").alias("n_chunks"))
    return files.join(n, "filename", "left").select("filename", F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n_chunks"))


def document_metadata(pages: DataFrame, source: str, folder: str, model: str) -> DataFrame:
    """(filename, filepath, md_filepath, n_pages, image_folder, model) of pages (filename, page); model is the embedding model's slug."""
    n = pages.groupBy("filename").agg(F.max("page").alias("n_pages"))
    base = stem(F.col("filename"))
    md, images = (F.concat_ws("/", F.lit(folder), F.concat(base, F.lit(x))) for x in (".md", "_images"))
    return n.select("filename", F.concat_ws("/", F.lit(source), "filename").alias("filepath"), md.alias("md_filepath"), "n_pages", images.alias("image_folder"), model_slug(F.lit(model)).alias("model"))
