"""Configuration, splitter chains and the batch plan from files to chunks."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_markdown, stem
from ..operators.chunking import SPLITTERS, chunk_metadata, split_chain
from ..sources.files import SUPPORTED, accepted, decode

def splitter_chain(splitter: str | None = None, markdown_first: bool = False, header_levels: int = 2, chunk_size: int = 1000, chunk_overlap: int = 150) -> list[dict]:
    """The header splitter first if asked for or named, then the named splitter; no choice, no stages."""
    if splitter is not None and splitter != "markdown" and splitter not in SPLITTERS:
        raise ValueError(f"unknown splitter {splitter!r}; there are {', '.join(('markdown', *SPLITTERS))}")
    out = [{"splitter": "markdown", "header_levels": header_levels}] if markdown_first or splitter == "markdown" else []
    if splitter and splitter != "markdown":
        out.append({"splitter": splitter, "chunk_size": chunk_size, "chunk_overlap": chunk_overlap})
    return out


#: The sections of a configuration and their keys; True: required.
_KEYS = {
    "": {"indexing": True, "embeddings": True, "preprocessing": True},
    "indexing": {"name": True, "description": False, "type": True, "distance": True, "alias": False, "folder": False, "retrieval_mode": False},
    "embeddings": {"deployment": True, "ollama": False, "kwargs": False, "dim": False},
    "preprocessing": {"storage": True, "images": True, "chunking": True},
    "storage": {"parent_folder": True, "input_folder": True, "output_folder": True, "allowed_extensions": True},
    "images": {"dpi": False, "tol": False, "pad": False, "caption_keywords": True},
    "chunking": {"markdown_first": False, "header_levels": False, "splitter": False, "chunk_size": False, "chunk_overlap": False},
}
#: What index types of configurations are here.
KINDS = {"faiss": "flat", "flat": "flat", "qdrant": "hybrid", "hybrid": "hybrid"}


def _section(raw: dict, name: str) -> dict:
    """The section, if its keys are known and none is missing."""
    if not isinstance(raw, dict):
        raise ValueError(f"{name or 'configuration'} must be an object")
    keys = _KEYS[name]
    unknown, missing = sorted(set(raw) - set(keys)), sorted(k for k, need in keys.items() if need and k not in raw)
    if unknown or missing:
        raise ValueError(f"{name or 'configuration'}: unknown keys {unknown}, missing keys {missing}")
    return raw


@dataclass
class Config:
    """What the plan needs."""

    source: str = "in"
    folder: str = "out"
    allowed: list[str] = field(default_factory=lambda: ["txt", "pdf"])
    dpi: int = 200
    tol: float = 40.0
    pad: float = 16.0
    keywords: list[str] = field(default_factory=lambda: ["Figure"])
    stages: list[dict] = field(default_factory=list)
    index_name: str = "index"
    index_folder: str = "index"
    description: str = ""
    alias: str | None = None
    kind: str = "flat"
    distance: str = "cosine"
    mode: str = "dense"
    model: str | list[str] = "hash"
    model_options: dict = field(default_factory=dict)
    dim: int = 64

    @classmethod
    def load(cls, text: str, app: str | None = None) -> Config:
        """From JSON: an object of applications, each with the sections indexing, embeddings and preprocessing, or one such object.

        app names the application; it may be left out if there is one only. Unknown and missing keys, formats that
        can't be read and unknown splitters, types and distances raise.
        """
        raw = json.loads(text)
        if app is not None:
            if app not in raw:
                raise ValueError(f"no application {app!r}; there are {sorted(raw)}")
            raw = raw[app]
        elif not set(raw) & set(_KEYS[""]) and len(raw) == 1:
            raw = next(iter(raw.values()))
        raw = _section(raw, "")
        index, model, pre = (_section(raw[n], n) for n in ("indexing", "embeddings", "preprocessing"))
        store, images, chunking = (_section(pre[n], n) for n in ("storage", "images", "chunking"))
        if index["distance"] not in ("cosine", "euclidean"):
            raise ValueError("distance is cosine or euclidean")
        kinds = index["type"] if isinstance(index["type"], list) else [index["type"]]
        if not kinds or not set(kinds) <= set(KINDS):
            raise ValueError(f"type is one of {sorted(KINDS)}")
        allowed = [e.lower().lstrip(".") for e in store["allowed_extensions"]]
        if not set(allowed) <= set(SUPPORTED):
            raise ValueError(f"extensions {sorted(set(allowed) - set(SUPPORTED))} can't be read")
        join = lambda child: f"{store['parent_folder'].rstrip('/')}/{store[child]}"
        optional = {"description": index.get("description"), "alias": index.get("alias"), "index_folder": index.get("folder"), "mode": index.get("retrieval_mode")}
        optional |= {"dpi": images.get("dpi"), "tol": images.get("tol"), "pad": images.get("pad"), "dim": model.get("dim"), "model_options": model.get("kwargs")}
        return cls(
            source=join("input_folder"), folder=join("output_folder"), allowed=allowed, keywords=list(images["caption_keywords"]), stages=splitter_chain(**chunking),
            index_name=index["name"], kind="hybrid" if "hybrid" in {KINDS[k] for k in kinds} else "flat", distance=index["distance"], model=model["deployment"],
            **{k: v for k, v in optional.items() if v is not None},
        )


def model_names(configs: DataFrame, app: str, text: str = "json") -> DataFrame:
    """(name): the distinct embedding models, in order, that configurations (json) name for an application, as one name or a list."""
    found = F.get_json_object(text, f"$['{app}'].embeddings.deployment")
    many = F.when(F.startswith(found, F.lit("[")), F.from_json(found, "array<string>")).otherwise(F.array(found))
    names = configs.select(F.explode(many).alias("name")).where(F.col("name").rlike(r".+/.+|^[a-zA-Z0-9._-]+$"))
    return names.distinct().orderBy("name")


def chunks(files: DataFrame, config: Config, decoder=None) -> tuple[DataFrame, DataFrame]:
    """(chunks, rejected) of files as scan_folder() gives them.

    Rejected are files of other formats and such that the decoder failed on, with the reason.
    """
    named = files.withColumn("filename", F.element_at(F.split("path", "/"), -1))
    good = accepted(F.col("filename"), config.allowed)
    pages = decode(named.where(good), decoder)
    bad = named.where(~good).select(F.col("path").alias("filepath"), F.lit("format").alias("reason"))
    failed = pages.where("page is null").select("filepath", F.col("md").alias("reason"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "md"))), lambda x: x["md"]), "\n\n")
    docs = pages.where("page is not null").groupBy(F.col("filepath").alias("doc_id")).agg(text.alias("md")).withColumn("md", normalize_markdown(F.col("md")))
    name = F.concat_ws("/", F.lit(config.folder), F.concat(stem(F.element_at(F.split("doc_id", "/"), -1)), F.lit(".md")))
    # without a splitter that measures texts there is nothing to count
    counted = any(x["splitter"] != "markdown" for x in config.stages)
    return chunk_metadata(split_chain(docs, config.stages), name, counted), bad.unionByName(failed)
