"""Helpers that the operators share: durable checkpoints, sizes, components, column checks."""

from __future__ import annotations

import pickle
import re
import tempfile
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def durable(df: DataFrame) -> DataFrame:
    """df, computed and written to the shared folder that spark.checkpoint.dir names.

    Its lineage ends there, so that a lost executor costs no recomputation. A folder of our
    own is used only where the session names none and runs on one machine, as in tests; on a
    cluster a session that names none is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="docloom-"))
    return df.checkpoint(eager=True)


def fitted(rows: DataFrame, order: list[str], train: Callable[[Iterator[pa.RecordBatch]], object]) -> object:
    """What `train` makes of the rows, a bounded sample, in one task of an executor: the driver gets the model only.

    train is given the rows in the stated order, batch by batch, and returns what can be pickled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(batches))], pa.binary())], ["model"])

    got = rows.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(got[0].model)) if got else train(iter(()))


def sampled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(_id, ..., text): the texts of the documents that ids (_id, ..., a bounded number of distinct rows) names.

    Of rows that share a doc_id the least text stands for all, so that a sample is the same in every run.
    """
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    return found.groupBy(*ids.columns).agg(F.min("text").alias("text"))


class Bags:
    """Many arrays end to end in one growing buffer for each kind, so that their memory goes back when they do."""

    def __init__(self, **kinds: str):
        self.parts = {n: array(k) for n, k in kinds.items()}
        self.at = [0]

    def add(self, **values: np.ndarray) -> None:
        for n, part in self.parts.items():
            part.frombytes(np.ascontiguousarray(values[n], np.dtype(part.typecode)).tobytes())
        self.at.append(len(part))

    def views(self, name: str) -> list[np.ndarray]:
        part = self.parts[name]
        flat = np.frombuffer(part, np.dtype(part.typecode)) if len(part) else np.empty(0, part.typecode)
        return [flat[a:b] for a, b in zip(self.at, self.at[1:])]


def within(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[dict]:
    """The rows of the batches as dicts, but those whose text would bring the texts so far to more than `most` bytes."""
    used = 0
    for batch in batches:
        for row in batch.to_pylist():
            n = len((row["text"] or "").encode("utf-8", "surrogatepass"))
            if used + n <= most:
                used += n
                yield row


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def internal(df: DataFrame, name: str) -> str:
    """A column name like `name` that df does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def forgotten(df: DataFrame) -> DataFrame:
    """durable(df) without the size that Spark estimated for it.

    The estimate of a join is the product of its sides, and a checkpoint keeps it: in a loop of joins its digits
    grow exponentially with the rounds, until planning takes longer than the joins.
    """
    d, spark = durable(df), df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(d._jdf.queryExecution().toRdd(), d._jdf.schema(), False), spark)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the undirected graph of edges (a, b): root is the smallest node reachable.

    Each round points every node that has a smaller neighbour to the least of them, follows the pointers to their
    ends by pointer jumping, and contracts the edges to these ends. Edges whose ends have met are gone, alike ones
    become one, so that later rounds join only what is left to do, and two rounds leave at most half of the
    nodes that have edges. Nodes may be of any type that has an order. The least neighbours of hot nodes
    are combined by min() before they are shuffled. The joins by a, b and root, on which a hub is hot, have an unaggregated
    shuffle on that side, so adaptive execution can split it, and one row for each node on the other.
    """

    def contracted(edges: DataFrame) -> DataFrame:
        return forgotten(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    rest = contracted(edges)
    label = rest.select(F.col("a").alias("node")).union(rest.select("b")).distinct().select("node", F.col("node").alias("root"))
    while not rest.isEmpty():
        up = forgotten(rest.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        while True:
            above = up.select(F.col("node").alias("root"), F.col("root").alias("top"))
            new = forgotten(up.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
            up = new.select("node", "root")
            if new.where("moved").isEmpty():
                break
        to = {c: up.select(F.col("node").alias(c), F.col("root").alias(f"{c}_top")) for c in ("a", "b", "root")}
        ends = rest.join(to["a"], "a", "left").join(to["b"], "b")
        rest = contracted(ends.select(F.coalesce("a_top", "a").alias("a"), F.col("b_top").alias("b")))
        label = label.join(to["root"], "root", "left").select("node", F.coalesce("root_top", "root").alias("root"))
    return forgotten(label)
