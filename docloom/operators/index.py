"""The vector and keyword index: a table keyed by filename, edited by whole files, searched exactly."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.lines import pieces
from ..functions.text import WORD


def delete_files(index: DataFrame, files: DataFrame) -> DataFrame:
    return index.join(files.select("filename").distinct(), "filename", "left_anti")


def deleted_counts(index: DataFrame, files: DataFrame) -> DataFrame:
    """(filename, removed) of the files that have rows."""
    return index.join(files.select("filename").distinct(), "filename", "left_semi").groupBy("filename").agg(F.count("*").alias("removed"))


def add_rows(index: DataFrame, rows: DataFrame) -> DataFrame:
    return index.unionByName(rows)


def upsert_files(index: DataFrame, worklist: DataFrame, rows: DataFrame) -> DataFrame:
    """Replace the rows of all files of the worklist by rows; a file without rows is cleared."""
    return add_rows(delete_files(index, worklist), rows)


def index_size(index: DataFrame) -> DataFrame:
    """(n): the number of rows."""
    return index.agg(F.count("*").alias("n"))


def registry_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Registry rows (name, distance, model, types): types unite where name, distance and model agree, else the new row counts."""
    o = old.select("name", F.col("distance").alias("od"), F.col("model").alias("om"), F.col("types").alias("ot"))
    same = (F.col("od") == F.col("distance")) & (F.col("om") == F.col("model"))
    types = F.array_sort(F.array_distinct(F.when(same, F.array_union("ot", "types")).otherwise(F.col("types"))))
    merged = new.join(o, "name", "left").select("name", "distance", "model", types.alias("types"))
    return merged.unionByName(old.join(new, "name", "left_anti").select("name", "distance", "model", F.array_sort("types").alias("types")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def l2_normalize(v: Column) -> Column:
    n = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a whole finite vector, and their matrix; all whole vectors must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty(0, np.int64), np.empty((0, 0))
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64(), safe=False).to_numpy(zero_copy_only=False)  # of the lists that are not null; a null component is NaN
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes, 0))
    bad = sizes < 0
    bad[owner[~np.isfinite(flat)]] = True
    lengths = np.unique(sizes[~bad])
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
    return np.flatnonzero(~bad), flat[~bad[owner]].reshape(int((~bad).sum()), *lengths.tolist() or (0,))


class Best:
    """The k candidates of each of n queries with the least keys, ties to the smaller id, of all blocks that are added."""

    def __init__(self, n: int, k: int):
        self.k, self.at, self.key, self.ids = k, np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.worst, self.last = np.full((n, 1), np.inf), np.full((n, 1), np.iinfo(np.int64).max)  # key and id of the k-th

    def add(self, key: np.ndarray, ids: np.ndarray) -> None:
        """key: queries times candidates; candidates with infinite keys take no part."""
        near = np.isfinite(key) & (key <= self.worst)
        if not near.any():
            return
        near &= (key < self.worst) | (ids[None] < self.last)
        if len(ids) > self.k and near.sum() > 4 * self.k * len(near):
            near &= key <= np.partition(key, self.k - 1, axis=1)[:, self.k - 1 : self.k]
        at, j = np.nonzero(near)
        at, key, ids = np.concatenate((self.at, at)), np.concatenate((self.key, key[at, j])), np.concatenate((self.ids, ids[j]))
        order = np.lexsort((ids, key, at))
        order = order[np.arange(len(at)) - np.searchsorted(at[order], at[order]) < self.k]
        self.at, self.key, self.ids = at[order], key[order], ids[order]
        full = np.flatnonzero(np.bincount(self.at, minlength=len(near)) == self.k)
        end = np.searchsorted(self.at, full, "right") - 1
        self.worst[full, 0], self.last[full, 0] = self.key[end], self.ids[end]


def _nearest(q_ids: np.ndarray, q: np.ndarray, k: int, metric: str, own: bool, cells: int = 1 << 20):
    """Keeps the k best of each query over all vectors of a task; at most about `cells` scores are held at once."""
    if metric == "cosine":
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)

    def keys(part: slice, x: np.ndarray) -> np.ndarray:
        """Distances, or negative similarities, of queries and vectors."""
        p = q[part]
        if metric == "cosine":
            return -np.round(p @ x.T, 6)
        both = (p * p).sum(1)[:, None] + (x * x).sum(1)[None]
        square = both - 2 * (p @ x.T)
        # cancellation makes small distances inexact; those are taken from the differences
        i, j = np.nonzero(square < 1e-6 * both)
        for some in np.array_split(np.arange(len(i)), max(1, -(-len(i) * q.shape[1] // cells))):
            square[i[some], j[some]] = ((p[i[some]] - x[j[some]]) ** 2).sum(1)
        return np.round(np.sqrt(np.maximum(square, 0)), 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(q_ids):
            return
        step = min(len(q_ids), 1024)
        width = max(1, cells // step)
        starts = range(0, len(q_ids), step)
        best = {a: Best(len(q_ids[a : a + step]), k) for a in starts}
        for batch in batches:
            for part in pieces(batch):
                rows, all_x = vectors_of(part.column(1))
                all_ids = part.column(0).to_numpy(zero_copy_only=False)[rows]
                for b in range(0, len(rows), width):
                    ids, x = all_ids[b : b + width], all_x[b : b + width]
                    if metric == "cosine":
                        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                    for a in starts:
                        span = slice(a, a + step)
                        key = keys(span, x)
                        best[a].add(key if own else np.where(ids[None] == q_ids[span, None], np.inf, key), ids)
        for a, found in best.items():
            if len(found.at):
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[a + found.at]), pa.array(found.ids), pa.array(-found.key if metric == "cosine" else found.key)], ["query_id", "vec_id", "score"])

    return run


def knn(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "cosine", query_bytes: int = 64 << 20, own: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score): exact nearest vectors by cosine similarity or L2 distance, ties to the smaller id.

    vectors and queries have vec_id (integer) and embedding; a query's own id is no answer, unless
    own is set. Scores are rounded to 6
    digits before they are ranked. Queries go to the vectors in groups of at most query_bytes, as one matrix each; a
    task multiplies it with its vectors block by block and passes on its k best of each query. Vectors that are null or hold
    null or non-finite components take no part; a zero vector's cosine is 0.
    """
    size = queries.agg(F.sum(F.size("embedding") * 8 + 8)).first()[0] or 0
    groups = max(1, -(-size // query_bytes))
    asked, out = queries.select("vec_id", "embedding"), None
    for g in range(groups):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g) if groups > 1 else asked
        table = part.toArrow()
        rows, q = vectors_of(table["embedding"])
        ids = np.array(table["vec_id"].to_pylist(), object)[rows].astype(np.int64)
        found = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_nearest(ids, q, k, metric, own), "query_id long, vec_id long, score double")
        out = found if out is None else out.unionByName(found)
    order = F.col("score").desc() if metric == "cosine" else F.col("score").asc()
    w = Window.partitionBy("query_id").orderBy(order, "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def words(text: Column | str) -> Column:
    """Lower-cased words of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{WORD}+"), F.lit(0))


def repeated(rows: DataFrame, key: str) -> bool:
    """Whether several rows share a key, or have none."""
    return not rows.groupBy(F.col(key).alias("k")).count().where("count > 1 or k is null").isEmpty()


def postings(chunks: DataFrame, key: str = "doc_id", text: str = "text", only: DataFrame | None = None, most: int = 1_000_000) -> DataFrame:
    """(term, key, tf, dl): the inverted index of lower-cased words, or of those in `only` (term).

    The words of a row are sorted and counted in place; nothing is shuffled, unless rows share a key: those are united.
    At most `most` terms of `only` are sent to the documents, more are joined.
    """
    rows = chunks.select(key, F.sort_array(words(text)).alias("w")).where(F.size("w") > 0)
    rows = rows.select(key, "w", F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: (i == 0) | (F.get("w", i) != F.get("w", i - 1))).alias("first"))
    counted = F.transform("first", lambda p, i: F.struct(F.get("w", p).alias("term"), (F.coalesce(F.get("first", i + 1), F.size("w")) - p).cast("long").alias("tf")))
    posts = rows.select(key, F.size("w").alias("dl"), F.explode(counted).alias("p")).select(key, "p.term", "dl", "p.tf")
    if only is not None:
        asked = only.select("term").distinct()
        posts = posts.join(F.broadcast(asked) if asked.limit(most + 1).count() <= most else asked, "term", "left_semi").select(key, "term", "dl", "tf")
    return posts.groupBy(key, "term", "dl").agg(F.sum("tf").alias("tf")) if repeated(chunks, key) else posts


def bm25(posts: DataFrame, n_docs: int, avg_len: float, queries: DataFrame, k: int, k1: float = 1.2, b: float = 0.75, key: str = "doc_id", most: int = 1_000_000) -> DataFrame:
    """(query_id, rank, key, score) of queries (query_id, term), each distinct term once; ties to the smaller key.

    Terms of the queries, if at most `most`, are sent to the postings: a common word is then no hot key, since nothing
    is dealt out by term. Its documents are counted before they are shuffled. More terms are joined.
    """
    asked = queries.select("query_id", "term").distinct()
    small = F.broadcast if asked.limit(most + 1).count() <= most else lambda df: df
    hits = posts.join(small(asked.select("term").distinct()), "term", "left_semi")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    wanted = asked.join(df, "term").select("term", "query_id", idf.alias("idf"))
    weight = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / avg_len))
    total = hits.join(small(wanted), "term").groupBy("query_id", key).agg(F.round(F.sum(weight), 6).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), key)
    return total.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _counts(part: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, how often) of the given terms in an array of lists of words; rows and terms by their place."""
    owner = np.repeat(np.arange(len(part)), pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False))
    found = pc.fill_null(pc.index_in(part.flatten(), value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    pair, tf = np.unique((owner * len(terms) + found)[found >= 0], return_counts=True)
    return pair // len(terms), pair % len(terms), tf


def bm25_documents(docs: DataFrame, queries: DataFrame, k: int, k1: float = 1.2, b: float = 0.75, key: str = "doc_id", text: str = "text", most: int = 1_000_000, cells: int = 1 << 20) -> DataFrame:
    """(query_id, rank, key, score) as bm25() gives it, from the documents themselves.

    A first pass counts documents, their words and those that hold each asked term, a second one scores documents
    block by block, at most about `cells` scores at once, and passes on the k best of a task for each query: pairs of queries
    and documents are never shuffled. The pairs (query, term) are sent to the documents; if there are more than `most`, or
    documents share a key or have no integer key, postings are made and joined instead.
    The mean length is that of documents that have a text.
    """
    asked = queries.select("query_id", "term").where("term is not null").distinct()
    kind, whole = asked.schema["query_id"].dataType.simpleString(), docs.schema[key].dataType.simpleString()
    if whole not in ("tinyint", "smallint", "int", "bigint") or asked.limit(most + 1).count() > most or repeated(docs, key):
        n, mean = docs.agg(F.count("*"), F.avg(F.when(F.col(text).isNotNull(), F.size(words(text))))).first()
        return bm25(postings(docs, key, text, asked, most), n, mean or 1.0, queries, k, k1, b, key, most)
    table = asked.toArrow()
    terms, names = (pa.chunked_array(table[c].chunks, table[c].type).unique() for c in ("term", "query_id"))
    term_of, query_of = (pc.index_in(table[c], value_set=v, skip_nulls=False).to_numpy().astype(np.int64) for c, v in (("term", terms), ("query_id", names)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, full, total = np.zeros(len(terms), np.int64), 0, 0, 0
        for batch in batches:
            for part in pieces(batch):
                w = part.column(1)
                df += np.bincount(_counts(w, terms)[1], minlength=len(terms))
                n, full, total = n + len(w), full + len(w) - w.null_count, total + (pc.sum(pc.list_value_length(w)).as_py() or 0)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1, -2, -3]), pa.array([*df[at], n, full, total])], ["t", "n"])

    rows = docs.select(F.col(key).cast("long").alias("k"), words(text).alias("w"))
    sums = {r.t: r.n for r in rows.mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect()} if len(terms) else {}
    n, mean = sums.get(-1, 0), sums.get(-3, 0) / max(1, sums.get(-2, 0))
    df = np.array([sums.get(t, 0) for t in range(len(terms))], float)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    step = min(len(names), 1024) or 1
    spans = []  # of queries: how many, and the queries of each term from a place on
    for a in range(0, len(names), step):
        mine = np.flatnonzero((query_of >= a) & (query_of < a + step))
        mine = mine[np.argsort(term_of[mine], kind="stable")]
        spans.append((min(step, len(names) - a), np.searchsorted(term_of[mine], np.arange(len(terms) + 1)), query_of[mine] - a))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(size, k) for size, _, _ in spans]
        wide = max(1, cells // step)
        for batch in batches:
            for part in pieces(batch):
                for at in range(0, len(part), wide):
                    block = part.slice(at, wide)
                    ids, w = block.column(0).to_numpy(zero_copy_only=False), block.column(1)
                    doc, term, tf = _counts(w, terms)
                    dl = pc.fill_null(pc.list_value_length(w), 0).to_numpy(zero_copy_only=False)[doc]
                    weight = idf[term] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / (mean or 1.0)))
                    for (size, place, query), found in zip(spans, best):
                        many = place[term + 1] - place[term]
                        total = np.zeros(size * len(block))
                        for some in np.split(np.arange(len(term)), np.flatnonzero(np.diff(np.cumsum(many) // cells)) + 1):
                            row = np.repeat(some, many[some])
                            nth = np.arange(len(row)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
                            total += np.bincount(query[place[term[row]] + nth] * len(block) + doc[row], weight[row], len(total))
                        total = total.reshape(size, len(block))
                        found.add(np.where(total > 0, -np.round(total, 6), np.inf), ids)
        for a, found in enumerate(best):
            if len(found.at):
                yield pa.RecordBatch.from_arrays([names.take(pa.array(a * step + found.at)), pa.array(found.ids), pa.array(-found.key)], ["query_id", key, "score"])

    total = rows.mapInArrow(score, f"query_id {kind}, `{key}` bigint, score double").withColumn(key, F.col(key).cast(whole))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), key)
    return total.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def fuse(a: DataFrame, b: DataFrame, k: int, c: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists (query_id, id, rank)."""
    both = a.select("query_id", "id", "rank").unionByName(b.select("query_id", "id", "rank"))
    total = both.groupBy("query_id", "id").agg(F.round(F.sum(1 / (c + F.col("rank"))), 9).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return total.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class Index:
    """A stored index of chunks: texts, vectors, and for a hybrid index the postings of their words.

    Rows go by a hash of their filename to one of `segments` segments. An edit reads and writes the segments of the
    files it touches only, into a new folder; then a manifest, which says where each segment is and how many rows and
    words it has, takes force as a whole by being created. Readers keep the manifest they began with; folders that no manifest of the last few names
    go by vacuum() alone. Two writers can't create one manifest: the later one fails and changes nothing.

    rows have filename, chunk_idx, page_content and, unless embed is given, embedding; other columns are kept.
    With the cosine distance vectors are stored normalised.
    """

    MODES = ("dense", "sparse", "hybrid")

    def __init__(self, spark: SparkSession, path: str, distance: str = "cosine", kind: str = "flat", embed: Callable[[str], Column] | None = None, segments: int = 16, mode: str = "dense"):
        if distance not in ("cosine", "euclidean") or kind not in ("flat", "hybrid") or mode not in self.MODES:
            raise ValueError("distance is cosine or euclidean, kind flat or hybrid, mode dense, sparse or hybrid")
        if mode != "dense" and kind == "flat":
            raise ValueError(f"a flat index has no {mode} search")
        self.spark, self.path = spark, path.rstrip("/")
        self.distance, self.kind, self.embed, self.segments, self.mode = distance, kind, embed, segments, mode

    def _fs(self):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def version(self) -> int:
        """Number of the manifest in force, -1 without one."""
        fs, path = self._fs()
        root = path(f"{self.path}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return max((int(n[1:-5]) for n in names if n[:1] == "m" and n.endswith(".json")), default=-1)

    def _manifest(self, version: int | None = None) -> dict:
        v = self.version() if version is None else version
        if v < 0:
            raise FileNotFoundError(f"no index at {self.path}")
        text = "\n".join(r.value for r in self.spark.read.text(f"{self.path}/manifests/m{v}.json", wholetext=True).collect())
        return json.loads(text)

    def exists(self) -> bool:
        return self.version() >= 0

    def _table(self, name: str, manifest: dict, only: set[str] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/{name}/{e['folder']}/index_segment={k}" for k, e in manifest["segments"].items() if e["rows"] and (only is None or k in only)]
        schema = StructType.fromJson(manifest["schema"][name])
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*paths).select(*schema.names) if paths else self.spark.createDataFrame([], schema)

    def load(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the one in force."""
        return self._table("rows", self._manifest(version))

    def postings(self) -> DataFrame:
        """(id, term, dl, tf) of a hybrid index."""
        return self._table("postings", self._manifest())

    def create(self, rows: DataFrame) -> None:
        """An index of these rows; nothing happens if there is one."""
        if not self.exists():
            self._write(None, self._prepared(rows), None)

    def open(self, rows: DataFrame | None = None) -> Index:
        """The index that exists, else a new one of rows."""
        if rows is None and not self.exists():
            raise FileNotFoundError(f"no index at {self.path}")
        if rows is not None:
            self.create(rows)
        return self

    def _segment(self) -> Column:
        return F.pmod(F.xxhash64("filename"), F.lit(self.segments)).cast("int")

    def _prepared(self, rows: DataFrame) -> DataFrame:
        if self.embed is not None:
            rows = rows.withColumn("embedding", self.embed("page_content"))
        if "embedding" in rows.columns and self.distance == "cosine":
            rows = rows.withColumn("embedding", l2_normalize(F.col("embedding")))
        made = {"id": F.xxhash64("filename", "chunk_idx"), "n_words": F.size(words("page_content"))}
        return rows.select(*(c for c in rows.columns if c not in made), *(v.alias(c) for c, v in made.items()))

    def _write(self, manifest: dict | None, rows: DataFrame, touched: set[str] | None) -> None:
        """rows become all there is of the touched segments (None: of all)."""
        n = self.version() + 1
        folder = f"index_edit=v{n}-{uuid.uuid4().hex[:8]}"
        rows.withColumn("index_segment", self._segment()).repartition("index_segment").write.partitionBy("index_segment").parquet(f"{self.path}/rows/{folder}")
        kept = StructType([f for f in rows.schema.fields])
        new = {"schema": {"rows": kept.jsonValue()}, "segments": dict(manifest["segments"]) if manifest else {}}
        written = self.spark.read.schema(StructType([*kept.fields, StructField("index_segment", IntegerType())])).parquet(f"{self.path}/rows/{folder}")
        sums = {str(r.index_segment): {"folder": folder, "rows": r.n, "words": r.w or 0} for r in written.groupBy("index_segment").agg(F.count("*").alias("n"), F.sum("n_words").alias("w")).collect()}
        for k in touched or ():
            new["segments"].pop(k, None)
        new["segments"] |= sums
        if self.kind == "hybrid":
            posts = postings(written.withColumn("_key", F.struct("id", "index_segment")), "_key", "page_content").select("_key.id", "term", "dl", "tf", "_key.index_segment")
            posts.repartition("index_segment", F.pmod(F.xxhash64("term"), F.lit(8))).sortWithinPartitions("index_segment", "term").write.partitionBy("index_segment").parquet(f"{self.path}/postings/{folder}")
            new["schema"]["postings"] = StructType(posts.schema.fields[:-1]).jsonValue()
        fs, path = self._fs()
        fs.mkdirs(path(f"{self.path}/manifests"))
        out = fs.create(path(f"{self.path}/manifests/m{n}.json"), False)  # fails if another writer was first
        out.write(bytearray(json.dumps(new).encode()))
        out.close()

    def _edit(self, files: DataFrame, rows: DataFrame | None) -> int:
        manifest = self._manifest()
        names = files.select("filename").distinct()
        if rows is not None:
            rows = self._prepared(rows)
        touched = {str(r.s) for r in (names if rows is None else names.unionByName(rows.select("filename"))).select(self._segment().alias("s")).distinct().collect()}
        old = self._table("rows", manifest, touched)
        removed = deleted_counts(old, names).agg(F.sum("removed")).first()[0] or 0
        if rows is not None or removed:
            kept = delete_files(old, names).select(*old.columns)
            self._write(manifest, kept if rows is None else kept.unionByName(rows, allowMissingColumns=True), touched)
        return removed

    def add(self, rows: DataFrame) -> None:
        self._edit(rows.limit(0), rows)

    def delete(self, files: DataFrame) -> int:
        """Number of rows removed of the files (filename)."""
        return self._edit(files, None)

    def upsert(self, worklist: DataFrame, rows: DataFrame) -> None:
        """Replace the rows of all files of the worklist by rows; a file without rows is cleared."""
        if self.exists():
            self._edit(worklist, rows)
        else:
            self.create(rows)

    def count(self) -> int:
        return sum(e["rows"] for e in self._manifest()["segments"].values())

    def search(self, queries: DataFrame, k: int, mode: str | None = None, depth: int | None = None) -> DataFrame:
        """(query_id, rank, id, score, filename, chunk_idx) of queries (query_id, text or embedding), by the index's mode or the one given.

        dense: nearest vectors; sparse: BM25 by the stored postings; hybrid: reciprocal ranks of the best `depth` (4 k) of both.
        """
        mode = mode or self.mode
        if mode not in self.MODES or mode != "dense" and self.kind == "flat":
            raise ValueError(f"no {mode} search in a {self.kind} index")
        manifest = self._manifest()
        rows, parts = self._table("rows", manifest), []
        n = k if mode != "hybrid" else depth or 4 * k
        if mode != "sparse":
            vector = F.col("embedding") if "embedding" in queries.columns else self.embed("text")
            asked = queries.select(F.col("query_id").cast("long").alias("vec_id"), vector.alias("embedding"))
            found = knn(rows.select(F.col("id").alias("vec_id"), "embedding"), asked, n, "cosine" if self.distance == "cosine" else "l2", own=True)
            parts.append(found.select("query_id", F.col("vec_id").alias("id"), "score", "rank"))
        if mode != "dense":
            size = sum(e["rows"] for e in manifest["segments"].values())
            total = sum(e["words"] for e in manifest["segments"].values())
            terms = queries.select("query_id", F.explode(words("text")).alias("term"))
            parts.append(bm25(self._table("postings", manifest), size, total / max(1, size) or 1.0, terms, n, key="id"))
        best = parts[0] if len(parts) == 1 else fuse(*parts, k)
        return best.join(rows.select("id", "filename", "chunk_idx"), "id").select("query_id", "rank", "id", "score", "filename", "chunk_idx")

    def vacuum(self, keep: int = 2) -> None:
        """Delete manifests but the last `keep`, and the folders that none of those names."""
        fs, path = self._fs()
        last = self.version()
        old = range(0, last - keep + 1)
        used = {e["folder"] for v in range(max(0, last - keep + 1), last + 1) for e in self._manifest(v)["segments"].values()}
        for v in old:
            fs.delete(path(f"{self.path}/manifests/m{v}.json"), False)
        for name in ("rows", "postings"):
            root = path(f"{self.path}/{name}")
            for s in fs.listStatus(root) if fs.exists(root) else ():
                if s.getPath().getName() not in used:
                    fs.delete(s.getPath(), True)

    def drop(self) -> None:
        fs, path = self._fs()
        if fs.exists(path(self.path)):
            fs.delete(path(self.path), True)


class Registry:
    """The stored list of indexes (name, distance, model, types), see registry_merge(): one small Parquet table, replaced as a whole."""

    SCHEMA = "name string, distance string, model string, types array<string>"

    def __init__(self, spark: SparkSession, path: str):
        self.index = Index(spark, path)
        self.spark = spark

    def load(self) -> DataFrame:
        return self.spark.createDataFrame([], self.SCHEMA) if not self.index.exists() else self.index.load().select("name", "distance", "model", "types")

    def merge(self, new: DataFrame) -> None:
        merged = registry_merge(self.load(), new).withColumns({"filename": F.col("name"), "chunk_idx": F.lit(0), "page_content": F.lit("")})
        self.index.upsert(merged.select("filename"), merged)
