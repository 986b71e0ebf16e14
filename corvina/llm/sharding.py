"""Sharding by best-fit-decreasing bin packing.

Equal texts form indivisible groups. Sorted by falling size, each group enters the bin with
the least room that still holds it, found in a balanced tree. It runs on two levels: in
each hash bucket small groups are packed into parcels of a fixed capacity, then parcels and
large groups, a bounded number of them, are packed into the shards.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvina.llm.common import cut

#: Parcels of a shard's even share: the packing of parcels is at most this fine.
FINE = 400
#: Groups packed by one task, and rows numbered by one.
BUCKET_GROUPS, RUN_ROWS = 50_000, 20_000


class RoomTree:
    """A treap of (room, bin): insert, delete and least room that holds a size, each in logarithmic time."""

    def __init__(self) -> None:
        self._chance = random.Random(7)
        self._root: list | None = None  # [key, priority, left, right]

    @staticmethod
    def _split(node: list | None, key: tuple) -> tuple[list | None, list | None]:
        """Nodes below ``key`` and the others."""
        low, high = [None, 0, None, None], [None, 0, None, None]
        a, b = low, high
        while node is not None:
            if node[0] < key:
                a[3], a = node, node
                node = node[3]
            else:
                b[2], b = node, node
                node = node[2]
        a[3] = b[2] = None
        return low[3], high[2]

    @staticmethod
    def _merge(a: list | None, b: list | None) -> list | None:
        top = [None, 0, None, None]
        at, side = top, 3
        while a is not None and b is not None:
            if a[1] > b[1]:
                at[side], at, side = a, a, 3
                a = a[3]
            else:
                at[side], at, side = b, b, 2
                b = b[2]
        at[side] = a if b is None else b
        return top[3]

    def insert(self, key: tuple) -> None:
        a, b = self._split(self._root, key)
        self._root = self._merge(self._merge(a, [key, self._chance.random(), None, None]), b)

    def take(self, size: int) -> tuple | None:
        """Remove and return the least key with room for ``size``, None without one."""
        node, parent, side = self._root, None, 0
        best = None
        while node is not None:
            if node[0][0] >= size:
                best, best_parent, best_side = node, parent, side
                parent, side, node = node, 2, node[2]
            else:
                parent, side, node = node, 3, node[3]
        if best is None:
            return None
        below = self._merge(best[2], best[3])
        if best_parent is None:
            self._root = below
        else:
            best_parent[best_side] = below
        return best[0]


def best_fit_decreasing(sizes: Iterable[int], capacity: int, bins: int | None = None) -> list[int]:
    """The bin of each size, the sizes given in falling order.

    New bins open as needed, up to ``bins``; then a size that fits nowhere enters the bin with
    the most room, over its capacity. A size above the capacity opens a bin of its own.
    """
    tree, out, used = RoomTree(), [], 0
    rooms: list[int] = []
    for size in sizes:
        got = tree.take(size)
        if got is None and (bins is None or used < bins):
            got, used = (capacity, used), used + 1
            rooms.append(capacity)
        if got is None:
            room = max(range(used), key=lambda i: (rooms[i], -i))
            # Take that bin's key out of the tree by its room; equal rooms are alike.
            over = tree.take(rooms[room]) if rooms[room] >= 0 else None
            got = over if over is not None else (rooms[room], room)
        room, k = got[0] - size, got[1]
        rooms[k] = room
        if room >= 0:
            tree.insert((room, k))
        out.append(k)
    return out


def even_bins(sizes: list[int], bins: int) -> list[int]:
    """Best fit decreasing into ``bins`` bins of the least capacity that holds all, sizes in falling order.

    Sizes above the even share of what is left get bins of their own first.
    """
    rest, left, alone = sum(sizes), bins, 0
    while left > 1 and alone < len(sizes) and sizes[alone] * left > rest:
        rest, left, alone = rest - sizes[alone], left - 1, alone + 1
    small = sizes[alone:]
    low = max(-(-rest // left), small[0] if small else 1)
    high, found = low, None
    while True:
        got = best_fit_decreasing(small, high)
        if not got or max(got) < left:
            found = got
            break
        low, high = high + 1, high + max(1, high // 1000)
    return [*range(alone), *(alone + k for k in found)]


def _pack_parcels(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        size = table["bytes"].to_pylist()
        key = table["g"].to_pylist()
        order = sorted(range(len(size)), key=lambda i: (-size[i], key[i]))
        bins = best_fit_decreasing([size[i] for i in order], capacity)
        bucket = table["bucket"][0].as_py()
        return pa.table({"g": pa.array([key[i] for i in order], pa.binary()), "bucket": pa.array([bucket] * len(order), pa.int64()), "bin": pa.array(bins, pa.int64()), "bytes": pa.array([size[i] for i in order], pa.int64()), "rows": pa.array([table["rows"][i].as_py() for i in order], pa.int64())})

    return run


def minimal_shards(sizes: list[int], capacity: int) -> list[int]:
    """Shards of a fixed capacity, as few as best fit decreasing needs; sizes in falling order."""
    return best_fit_decreasing(sizes, capacity)


def shard(docs: DataFrame, shards: int | None = None, *, capacity: int | None = None, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text", fine: int = FINE) -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, shard, slot.

    Give either a number of ``shards``, filled nearly evenly by bytes, or the ``capacity`` of
    one, of which as few as the packing needs are filled. Size is the text's UTF-8 bytes plus
    ``overhead``; a null text counts as an empty one. Equal texts share a shard; a group above the
    capacity gets a shard of its own. Slots run from 0 in each shard.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    raw = text.cast("binary")
    rows = cut(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(raw).alias("crc"), F.unhex(F.md5(raw)).alias("g")))
    groups = cut(rows.groupBy("g").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    total = groups.agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).first()
    goal = capacity if capacity is not None else -(-(total["bytes"] or 1) // shards)
    parcel = max(1, goal // fine)
    buckets = max(1, -(-total["n"] // BUCKET_GROUPS))
    # A bucket leaves a part-filled parcel or two, so it gets enough bytes to fill many.
    buckets = min(buckets, max(1, (total["bytes"] or 1) // (20 * parcel)))
    # Groups too large for a parcel are at most total / parcel: they go on by themselves.
    small = groups.where(F.col("bytes") <= parcel).withColumn("bucket", F.pmod(F.xxhash64("g"), F.lit(buckets)))
    large = groups.where(F.col("bytes") > parcel).select("g", F.lit(-1).cast("long").alias("bucket"), F.xxhash64("g").alias("bin"), "bytes", "rows")
    packed = cut(small.groupBy("bucket").applyInArrow(_pack_parcels(parcel), "g binary, bucket long, bin long, bytes long, rows long").unionByName(large))
    parcels = packed.groupBy("bucket", "bin").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("g").alias("g"))
    # At most about 2 x shards x fine + buckets rows, whatever the number of documents.
    found = sorted(((r["bytes"], bytes(r["g"]), r["bucket"], r["bin"], r["rows"]) for r in parcels.toLocalIterator()), key=lambda r: (-r[0], r[1]))
    sizes = [r[0] for r in found]
    into = even_bins(sizes, shards) if capacity is None else minimal_shards(sizes, capacity)
    filled: dict[int, int] = {}
    plan = []
    for (_, _, bucket, bin_, n), k in zip(found, into):
        plan.append((bucket, bin_, k, filled.get(k, 0), max(1, -(-n // RUN_ROWS))))
        filled[k] = filled.get(k, 0) + n
    plan = docs.sparkSession.createDataFrame(plan or [(0, 0, 0, 0, 1)], "bucket long, bin long, shard int, base long, runs long")
    # Rows of a parcel are numbered in runs, so a large group of copies meets in no single task.
    where = packed.select("g", "bucket", "bin").join(F.broadcast(plan), ["bucket", "bin"])
    rows = rows.join(where, "g").withColumn("run", F.pmod(F.xxhash64("id"), F.col("runs")))
    rows = cut(rows.select("id", "size", "crc", "shard", "base", "bucket", "bin", "run"))
    runs = rows.groupBy("bucket", "bin", "run").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket", "bin").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("bucket", "bin", "run").orderBy("id", "crc", "size"))
    numbered = rows.join(runs, ["bucket", "bin", "run"]).withColumn("slot", F.col("base") + F.col("before") + place - 1)
    return numbered.select("id", "size", F.col("crc").alias("text_crc32"), "shard", F.col("slot").cast("long").alias("slot"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 24 shards of nearly equal bytes, equal texts together."""
    found = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_sharding": op4_sharding}
ORACLES: dict[str, str] = {}
