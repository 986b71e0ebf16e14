"""Mixing sources to target weights with DataFrame functions only.

Every source gets a target of words; a document's copies average target / size of its
source. The fractional parts are settled by pivotal rounding: of two documents one passes
word mass to the other until a copy number is whole, so the source's words stay as they
are. Groups of about ``FAN_IN`` documents settle all but one each; the residuals meet again in
the next level of a reduction tree, and the last one of a source goes to the nearer side.

Rows that agree in all that counts are counted first. Of m of them, whole copies are given at once and one fraction
goes on, so that a hot group of equal rows never meets in a task; very large groups go on in several parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvina.llm.common import DARK, cut

FAN_IN = 48
#: Sources whose targets are broadcast to the documents; beyond it they are joined by shuffle.
BROADCAST_SOURCES = 50_000
#: Equal rows that go on as one part.
PART_ROWS = 10_000


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, size): ``share`` of all sizes dealt by weight.

    Weights repeat over the sources in code-point order, null last. A target stops at ``cap``
    times its source's size and the excess is dealt to the others by weight until none is
    above. That is target = min(cap x size, level x weight) with one level for all.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    each = each.withColumn("w", w).withColumn("top", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("top") / F.col("w"))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    before = F.coalesce(F.sum("top").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    each = each.withColumn("level", (total - before) / after)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(whole)["level"]
    return each.withColumn("level", level).select("source", "source_size", F.when(F.col("level").isNull() | (F.col("ratio") < F.col("level")), F.col("top")).otherwise(F.col("level") * F.col("w")).alias("target"))


def _chance(*key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 11) / F.lit(float(1 << 53))


def _settle(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """(source, rest, done): one group of rows settled; ``rest`` is its last fractional row or null."""
    row = "struct<h:bigint,p:double,size:bigint,base:int,m:bigint,ups:bigint,id:string,payload:string>"
    got = f"struct<rest:{row},done:array<struct<row:{row},up:int>>>"

    def settled(r: Column, up: int) -> Column:
        return F.struct(r.alias("row"), F.lit(up).alias("up"))

    def left(r: Column, p: Column) -> Column:
        return F.struct(r["h"].alias("h"), p.alias("p"), r["size"].alias("size"), r["base"].alias("base"), r["m"].alias("m"), r["ups"].alias("ups"), r["id"].alias("id"), r["payload"].alias("payload"))

    def out(rest: Column, done: Column) -> Column:
        return F.struct(rest.alias("rest"), done.alias("done")).cast(got)

    none = F.lit(None).cast(row)

    def step(acc: Column, x: Column) -> Column:
        c, done = acc["rest"], acc["done"]
        room, mass, x_room, x_mass = (1 - c["p"]) * c["size"], c["p"] * c["size"], (1 - x["p"]) * x["size"], x["p"] * x["size"]
        up, down = F.least(room, x_mass), F.least(mass, x_room)
        rise = _chance(c["h"], x["h"], F.lit(level), F.lit(seed)) * (up + down) < down
        add = lambda r, n: F.concat(done, F.array(settled(r, n)))
        both = lambda n, m: out(none, F.concat(done, F.array(settled(c, n), settled(x, m))))
        risen = F.when(room < x_mass, out(left(x, x["p"] - up / x["size"]), add(c, 1))).when(room > x_mass, out(left(c, c["p"] + up / c["size"]), add(x, 0))).otherwise(both(1, 0))
        fallen = F.when(mass < x_room, out(left(x, x["p"] + down / x["size"]), add(c, 0))).when(mass > x_room, out(left(c, c["p"] - down / c["size"]), add(x, 1))).otherwise(both(0, 1))
        return F.when(c.isNull(), out(x, done)).when(rise, risen).otherwise(fallen)

    first = out(none, F.array().cast(f"array<struct<row:{row},up:int>>"))
    groups = rows.groupBy("source", "bucket").agg(F.array_sort(F.collect_list(F.struct("h", "p", "size", "base", "m", "ups", "id", "payload").cast(row))).alias("l"))
    return groups.select("source", F.aggregate("l", first, step).alias("a")).select("source", "a.rest", "a.done")


def _mixed(docs: DataFrame, weights: Sequence[float], share: float, cap: float, seed: int, id_col: str, source_col: str, text_col: str, payload: Column | None) -> tuple[DataFrame, DataFrame]:
    """(rows, targets): rows has id, payload, source, size, and of m equal rows how many get base + 1 copies (ups), the others base."""
    text = F.col(text_col)
    carried = F.lit(None).cast("string") if payload is None else payload
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), carried.alias("payload"), F.coalesce(F.regexp_count(text, F.lit(DARK)), F.lit(0)).cast("long").alias("size"))
    kinds = dict(rows.dtypes)
    rows = cut(rows.groupBy("id", "source", "payload", "size").agg(F.count("*").alias("m")))
    targets = cut(source_targets(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("size")), weights, share, cap))
    n_sources = targets.count()
    near = F.broadcast(targets) if n_sources <= BROADCAST_SOURCES else targets
    near = near.withColumnRenamed("source", "source_")
    rows = rows.join(near, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    x = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("base", F.floor(x).cast("int")).withColumn("p", x - F.floor(x)).withColumn("parts", F.ceil(F.col("m") / PART_ROWS))
    # Parts are as large as each other but for one row.
    part = F.when(F.col("m") <= PART_ROWS, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    rows = rows.withColumn("part", F.explode(part)).withColumn("m", F.floor(F.col("m") / F.col("parts")) + (F.col("part") < F.col("m") % F.col("parts")).cast("long"))
    mass = F.col("m") * F.col("p")
    rows = rows.withColumn("ups", F.floor(mass)).withColumn("p", mass - F.floor(mass))
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    # Documents without words get the floor.
    whole = rows.where(~open_).select("id", "payload", "source", "size", "base", "m", F.when(F.col("size") > 0, F.col("ups")).otherwise(0).cast("long").alias("ups"))
    h = F.xxhash64(F.col("id").cast("string"), "size", "payload", F.lit(seed), "part")
    rest = rows.where(open_).select("source", h.alias("h"), "p", "size", "base", "m", "ups", F.col("id").cast("string").alias("id"), F.col("payload").cast("string").alias("payload"))
    done, level, n = [], 0, rest.groupBy("source").count()
    largest = n.agg(F.max("count")).first()[0] or 0
    while largest > 0:
        last = largest <= FAN_IN
        # A source's own number of rows decides its buckets, so no source makes long or very many groups.
        share_of = n.select(F.col("source").alias("s_"), F.greatest(F.ceil(F.col("count") / FAN_IN), F.lit(1)).alias("buckets"))
        share_of = F.broadcast(share_of) if n_sources <= BROADCAST_SOURCES else share_of
        keyed = rest.join(share_of, F.col("source").eqNullSafe(F.col("s_"))).withColumn("bucket", F.lit(0) if last else F.pmod(F.xxhash64("h", F.lit(level)), F.col("buckets")))
        got = cut(_settle(keyed, level, seed))
        done.append(got.select("source", F.explode("done").alias("d")).select("d.row.id", "d.row.payload", "source", "d.row.size", "d.row.base", "d.row.m", (F.col("d.row.ups") + F.col("d.up")).alias("ups")))
        rest = got.where("rest is not null").select("source", "rest.*")
        if last:
            done.append(rest.select("id", "payload", "source", "size", "base", "m", (F.col("ups") + (F.col("p") >= 0.5).cast("long")).alias("ups")))
            break
        n = rest.groupBy("source").count()
        largest, level = n.agg(F.max("count")).first()[0] or 0, level + 1
    out = whole
    for d in done:
        out = out.unionByName(d.select(F.col("id").cast(kinds["id"]), F.col("payload").cast(kinds["payload"]), "source", "size", "base", "m", "ups"))
    return out, near


def mix(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", payload: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, payload, source, size, source_size, target, copies.

    Size is the number of words between ASCII white space; a null text has 0. copies is the
    floor or ceiling of target / source_size, at most ``cap`` rounded up. Sizes times copies sum to each
    source's target but for half of its largest document at most. Documents of size 0 get the
    floor. Equal inputs give equal copies, however they are stored; rows that repeat id, source, size and
    payload share theirs. ``payload`` is any column to carry along.
    """
    rows, near = _mixed(docs, weights, share, cap, seed, id_col, source_col, text_col, payload)
    up = lambda i: (F.col("base") + (i <= F.col("ups")).cast("int")).alias("copies")
    one = rows.where("m = 1").select("id", "payload", "source", "size", up(F.lit(1)))
    many = rows.where("m > 1").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m")))).select("id", "payload", "source", "size", up(F.col("i")))
    return one.unionByName(many).join(near, F.col("source").eqNullSafe(F.col("source_")), "left").select("id", "payload", "source", "size", "source_size", "target", "copies")


def repeat(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, 0 times included; columns as they are.

    Of rows alike in every column only the number of their copies matters, so one of them is repeated for all.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    at = {c: n for c, n in zip(docs.columns, names)}
    rows, _ = _mixed(inner, weights, share, cap, seed, at[id_col], at[source_col], at[text_col], F.xxhash64(*names))
    copies = rows.groupBy(F.col("id").alias("__id"), F.col("payload").alias("__p")).agg(F.sum(F.col("m") * F.col("base") + F.col("ups")).alias("n"), F.sum("m").alias("rows"))
    joined = inner.withColumn("__h", F.xxhash64(*names)).join(copies.where("n > 0"), F.col(at[id_col]).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__p")))
    one = joined.where("rows = 1")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / PART_ROWS)))
    many = joined.where("rows > 1").dropDuplicates(["__id", "__h"]).withColumn("__part", parts).repartition(F.col("__h"), F.col("__part"))
    many = many.withColumn("n", F.least(F.col("n") - F.col("__part") * PART_ROWS, F.lit(PART_ROWS))).drop("__part")
    return one.unionByName(many).withColumn("__k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n").cast("long")))).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    found = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


QUERIES = {"op5_mixing": op5_mixing}
ORACLES: dict[str, str] = {}
