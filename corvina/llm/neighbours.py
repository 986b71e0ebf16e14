"""Nearest neighbours by inner product with vantage-point trees.

Inner products become distances by one more coordinate: with M the largest norm, a vector
x gets sqrt(M^2 - |x|^2) and a query 0, so the nearest vectors have the largest product. Rows are
dealt into shards of bounded size; each shard's tree keeps, for each node, the range of distances
from its vantage point to each child. Blocks of queries walk the tree together; a child is
left out where the triangle inequality, times the factor, puts it beyond the k-th best.
Factor 1 is exact; larger factors prune more.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvina.llm.common import cut

#: Rows of a shard, queries of a block and rows of a leaf.
SHARD, BLOCK, LEAF = 8192, 2048, 192
#: Part of the largest norm by which bounds are widened, far above the rounding of distances.
SLACK = 1e-6


def build_tree(x: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """A vantage-point tree of the rows of ``x``: row order, and per node its slice, vantage row, children and ranges."""
    order = np.arange(len(x))
    nodes: list[list[float]] = []

    def grow(a: int, b: int) -> int:
        me = len(nodes)
        nodes.append([a, b, -1, -1, -1, 0.0, 0.0, 0.0, 0.0])
        if b - a > leaf:
            rows = order[a:b]
            v = rows[np.argmax(((x[rows] - x[rows].mean(0)) ** 2).sum(1))]
            d = np.sqrt(((x[rows] - x[v]) ** 2).sum(1))
            by = np.argsort(d, kind="stable")
            order[a:b], d = rows[by], d[by]
            mid = (b - a) // 2
            if d[0] < d[-1]:
                left, right = grow(a, a + mid), grow(a + mid, b)
                nodes[me] = [a, b, v, left, right, d[0], d[mid - 1], d[mid], d[-1]]
        return me

    if len(x):
        grow(0, len(x))
    return {"order": order, "nodes": np.array(nodes, float).reshape(-1, 9)}


def search_tree(x: np.ndarray, tree: dict[str, np.ndarray], q: np.ndarray, k: int, factor: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Distances and rows of the k nearest rows of each query, inf and -1 where there are fewer."""
    best = np.full((len(q), k), np.inf)
    rows = np.full((len(q), k), -1, np.int64)
    nodes, order = tree["nodes"], tree["order"]

    def walk(i: int, who: np.ndarray) -> None:
        a, b, v, left, right, *ranges = nodes[i]
        if v < 0:
            at = order[int(a) : int(b)]
            c = x[at]
            d = np.sqrt(np.maximum((q[who] ** 2).sum(1)[:, None] + (c**2).sum(1)[None] - 2 * q[who] @ c.T, 0))
            d, r = np.concatenate([best[who], d], 1), np.concatenate([rows[who], np.broadcast_to(at, d.shape)], 1)
            top = np.argpartition(d, k - 1, 1)[:, :k]
            best[who], rows[who] = np.take_along_axis(d, top, 1), np.take_along_axis(r, top, 1)
            return
        d = np.sqrt(((q[who] - x[int(v)]) ** 2).sum(1))
        bounds = [np.maximum(np.maximum(lo - d, d - hi), 0) for lo, hi in (ranges[:2], ranges[2:])]
        near = bounds[0] <= bounds[1]
        for turn in (0, 1):  # each query takes its nearer child first
            for side, child in ((0, left), (1, right)):
                mine = near if side == turn else ~near
                mine = mine & (bounds[side] * factor <= best[who].max(1) + slack)
                if mine.any():
                    walk(int(child), who[mine])

    if len(nodes) and len(q):
        walk(0, np.arange(len(q)))
    return best, rows


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _usable(v: Column) -> Column:
    """Neither null nor zero, and every component finite."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def _product(a: Column, b: Column) -> Column:
    """The inner product in double precision, summed in order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def nearest(rows: DataFrame, is_query: Column, *, k: int = 20, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k largest inner products of each query with the other rows, ties to the smaller id.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part,
    nor do those of another length than the most frequent one (the smaller of two), nor rows with
    a null id. Of equal vectors only the k + 1 smallest ids can be among the nearest, so no
    others are searched. Rows that repeat an id and vector count once. A query's own id is left out.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    mine = rows.select(F.col(id_col).alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    mine = mine.where(F.col("id").isNotNull() & _usable(F.col("v"))).distinct()
    mine = cut(mine.withColumn("d", F.size("v")))
    top = mine.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    if top is None:
        kind = mine.schema["id"].dataType.simpleString()
        return mine.select(F.col("id").cast(kind).alias("query_id"), F.lit(1).alias("rank"), "id", F.lit(0.0).alias("score")).where("false")
    mine = mine.where(F.col("d") == top["d"]).drop("d")
    # Distances are those of vectors divided by the largest component of all, so no square overflows; scores are of the vectors themselves.
    unit = mine.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    small = F.transform("v", lambda x: x / unit)
    stats = mine.agg(F.max(_product(small, small)).alias("m"), F.count_if("q").alias("q")).first()
    m2, n, n_queries = stats["m"], top["count"], stats["q"]
    shards, blocks = max(1, -(-n // shard)), max(1, -(-n_queries // block))
    same = Window.partitionBy("v").orderBy("id")
    held = mine.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1)
    h = F.xxhash64("id")
    index = held.select(F.pmod(h, F.lit(shards)).alias("shard"), "id", "v").groupBy("shard").applyInArrow(_index(m2, unit), "shard long, tree binary")
    # Equal query vectors are searched once.
    asked = mine.where("q").groupBy("v").agg(F.min("id").alias("qid"))
    packed = asked.select(F.pmod(F.xxhash64("qid"), F.lit(blocks)).alias("block"), "qid", "v").groupBy("block").applyInArrow(_queries, "block long, queries binary")
    packed = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    kind = mine.schema["id"].dataType.simpleString()
    hits = index.join(packed, "shard").repartition(max(1, min(shards * blocks, 4096)), "shard", "block").select("tree", "queries").mapInArrow(_search(k + 1, factor, m2, unit), f"qid {kind}, id {kind}, score double")
    near = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    best = hits.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1).select("qid", "id", "score")
    who = mine.where("q").join(asked, "v").select("qid", F.col("id").alias("query_id"))
    out = who.join(best, "qid").where("id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lifted(x: np.ndarray, m2: float, unit: float) -> np.ndarray:
    """Vectors in units of the largest component, all of the length sqrt(m2) by one more component."""
    x = x / unit
    return np.c_[x, np.sqrt(np.maximum(m2 - (x**2).sum(1), 0))]


def _index(m2: float, unit: float):
    def run(table: pa.Table) -> pa.Table:
        x = _matrix(table["v"])
        ids = table["id"].to_numpy()
        by = np.argsort(ids, kind="stable")
        x, ids = x[by], ids[by]
        tree = build_tree(_lifted(x, m2, unit))
        return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int64()), "tree": pa.array([_pack(ids=ids, x=x, **tree)], pa.binary())})

    return run


def _queries(table: pa.Table) -> pa.Table:
    return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int64()), "queries": pa.array([_pack(ids=table["qid"].to_numpy(), x=_matrix(table["v"]))], pa.binary())})


def _search(k: int, factor: float, m2: float, unit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, queries in zip(batch.column(0), batch.column(1)):
                t, q = np.load(io.BytesIO(tree.as_py())), np.load(io.BytesIO(queries.as_py()))
                ids, x, qx = t["ids"], t["x"], q["x"]
                y = _lifted(x, m2, unit)
                slack = SLACK * np.sqrt(m2)
                # A query's length changes no order of its products: M brings it among the rows.
                small = qx / np.abs(qx).max(1, keepdims=True)
                ask = np.c_[small / np.sqrt((small**2).sum(1))[:, None] * np.sqrt(m2), np.zeros(len(qx))]
                # More than k: rows within rounding of the k-th are settled by the exact product.
                wide = min(k + 16, len(x))
                best, rows = search_tree(y, {"order": t["order"], "nodes": t["nodes"]}, ask, wide, factor, slack)
                best.sort(1)
                unsure = best[:, -1] - best[:, min(k, wide) - 1] <= slack if wide < len(x) else np.zeros(len(qx), bool)
                out: list[list[np.ndarray]] = [[], [], []]
                for i in range(len(qx)):
                    at = np.arange(len(x)) if unsure[i] else rows[i][rows[i] >= 0]
                    with np.errstate(over="ignore", invalid="ignore"):
                        s = np.cumsum(x[at] * qx[i], 1)[:, -1]  # one product after the other, as SQL sums them
                    top = np.lexsort((ids[at], -s))[:k]
                    for column, value in zip(out, (np.repeat(q["ids"][i], len(top)), ids[at][top], s[top])):
                        column.append(value)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["qid", "id", "score"])

    return run


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each twentieth vector by inner product."""
    found = nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


QUERIES = {"op3_nearest": op3_nearest}
ORACLES = {
    "op3_nearest": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), lambda s, x: s + x) AS score
      FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
}
