"""Shared parts of the training-data operators: words, checkpoints, connected components."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words of ASCII letters, digits and anything beyond ASCII, once A-Z are lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Edges, of 16 bytes each, that one task may hold.
EDGES_OF_A_TASK = 1_000_000
#: Whether a query's shuffle files are removed at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A word between ASCII white space.
DARK = r"[^\x20\x09-\x0D]+"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the session's own setting, else one set here.

    Without a setting, a local session gets a temporary folder and any other master a
    folder in the warehouse, which executors share.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
            where = tempfile.mkdtemp(prefix="corvina-") if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        sc.setCheckpointDir(where)
    return sc.getCheckpointDir()


def shielded(df: DataFrame, *cols: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named f0, f1, …, and the new names of ``cols``: no name in it can clash with an operator's own."""
    names = df.columns
    return df.toDF(*[f"f{i}" for i in range(len(names))]), [f"f{names.index(c)}" for c in cols]


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there: later reads survive lost executors."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        # The setting holds for plans that are made under it; shuffle files then go as soon as the rows are written, whoever still refers to ``df``.
        out = df.select("*").checkpoint(eager=True)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)
    # Checkpoints of earlier steps go when both Python and the driver's JVM have collected what refers to them.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def give_back() -> None:
    """At a Python task's end: free memory goes back to the machine, since a reused worker would keep it."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library has no such call


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and everything else as it is; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """The runs of ASCII letters and digits and characters beyond ASCII, A-Z in lower case."""
    return F.array_remove(F.split(lower_ascii(text), NOT_WORD), "")


def _components_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of one task's edges: labels fall to the least of each edge's ends and jump ahead until none changes."""
    edges = [np.stack([batch.column(i).to_numpy() for i in range(2)]) for batch in batches]
    if not edges:
        return
    nodes, ends = np.unique(np.concatenate(edges, axis=1), return_inverse=True)
    u, v = ends.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for at in (u, v, label[u], label[v]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "root"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", *, arrow: bool = False) -> DataFrame:
    """(node, root) for every node of an undirected edge list; root is the component's smallest node.

    Alternates large-star and small-star steps until the edges no longer change, each step
    a pair of keyed aggregations and joins, cut to the shared folder. Loops and repeated
    edges are harmless; an edge with a null end is ignored; no edges give no rows. Up to EDGES_OF_A_TASK
    edges are one partition, whose steps need no exchange, or one Arrow task with ``arrow``, which takes numbers as
    nodes; more are dealt out as usual.
    """
    e = cut(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("u", "v")))
    seen = e.agg(mark).first()[0]
    if seen[0] <= EDGES_OF_A_TASK:
        e = e.coalesce(1)
        if arrow:
            return cut(e.mapInArrow(_components_of_batches, "node long, root long"))
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("w"))
        small = large.join(low, "u").where("v != w").select(F.col("v").alias("u"), F.col("w").alias("v"))
        e = cut(small.unionByName(low.withColumnRenamed("w", "v")).distinct())
        now = e.agg(mark).first()[0]
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
