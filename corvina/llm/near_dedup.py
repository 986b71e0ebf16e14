"""Near-duplicate documents by bottom-k sketches of one hash function.

Every distinct text gets the k smallest hashes of its word shingles. Inverted lists of the
retained values propose pairs: a text enters only the lists of its rarest values, as many
as two texts that must share ``need`` of their k values can't both miss. In a long list texts are first compared with its first
text, then each with a few drawn from one of its lists, so large groups of copies make no
quadratic number of pairs. What is in different groups then is compared in cells of bounded size, and
only pairs that may be linked leave a cell. A union-sketch estimate thins the proposals
and the exact Jaccard similarity of the full shingle sets confirms the rest.

A text's odd sketch has a bit for the parity of the shingles of each bucket. Where the bits of two texts
differ, at least one shingle is in one set alone, so the number of differing bits is a lower bound of
the sets' difference: it drops unlinked members of one family of copies and never a link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvina.llm.common import connected_components, cut, give_back, shielded

#: Retained values of a text, and how many of them two texts at the threshold share but for chances below 1e-13.
K, NEED = 64, 24
#: Differing bits allowed of 128 and of 256 one-bit minhashes, missed with chances below 1e-10 at similarity 0.8.
FEW_BITS, MANY_BITS = 42, 64
#: Lists of at most so many texts are compared pair by pair at once; longer ones in cells of about CELL texts.
SHORT_LIST, CELL = 16, 1024
#: Texts drawn from a long list to be compared with its members.
HEADS = 16
#: Bits of an odd sketch, in numbers of 64.
ODD_BITS = 1024
#: Buckets of the broadcast set that thins the texts before they are shuffled: the set's size is bounded by it.
BUCKETS = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(words: list[bytes], length: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words than ``length`` make one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    if len(known) > 200_000:
        known.clear()
    out = []
    for w in words:
        if (h := known.get(w)) is None:
            known[w] = h = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        out.append(h)
    h = np.array(out, np.uint64)
    n = min(length, len(h))
    with np.errstate(over="ignore"):
        s = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            s = (s ^ h[i : len(h) - n + 1 + i]) * _MIX
            s ^= s >> np.uint64(29)
        s = s * np.uint64(0xBF58476D1CE4E5B9)
        s ^= s >> np.uint64(32)
    return np.unique(s)


def _signature(h: np.ndarray) -> list[int]:
    """256 bits as four numbers: one of the smallest hash in each of 256 ranges, 0 for an empty range."""
    bits = np.zeros(256, np.uint8)
    if len(h):
        at = h >> np.uint64(56)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        with np.errstate(over="ignore"):
            bits[at[first].astype(np.int64)] = (h[first] * np.uint64(0x94D049BB133111EB)) >> np.uint64(63)
    return np.packbits(bits).view(">i8").tolist()


def _odd(h: np.ndarray) -> list[int]:
    """Whether the number of hashes in each of ODD_BITS buckets is odd; the buckets don't follow the hashes' order."""
    counts = np.bincount((h & np.uint64(ODD_BITS - 1)).astype(np.int64), minlength=ODD_BITS)
    return np.packbits(counts.astype(np.uint8) & 1).view(">i8").tolist()


_SKETCH = "rid long, key binary, n int, s1 long, s2 long, s3 long, s4 long, odd array<long>, sketch array<long>"


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The column's texts, a few at a time as Python strings."""
    for a in range(0, len(column), 64):
        yield from column.slice(a, 64).to_pylist()


def _sketcher(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        seen: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for rid, text in zip(batch["rid"].to_pylist(), _texts(batch["text"])):
                raw = (text or "").encode("utf-8", "surrogatepass")
                key = hashlib.md5(raw).digest()
                if key in seen:
                    rows.append((rid, key, seen[key], None, None, None, None, None, None))
                    continue
                h = shingle_hashes(raw.lower().split(), length, known)
                if len(seen) > 100_000:
                    seen.clear()
                seen[key] = len(h)
                rows.append((rid, key, len(h), *_signature(h), _odd(h), h[:k].astype(np.int64)))
            ids = batch["id"]
            kinds = (pa.int64(), pa.binary(), pa.int32(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2)
            names = ["id", "rid", "key", "n", "s1", "s2", "s3", "s4", "odd", "sketch"]
            yield pa.RecordBatch.from_arrays([ids, *([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds])], names)
        give_back()

    return run


def _verifier(length: int, percent: int):
    def shingles(text: str) -> set:
        w = text.encode("utf-8", "surrogatepass").lower().split()
        n = min(length, len(w))
        return set(zip(*(w[i : len(w) - n + 1 + i] for i in range(n)))) if w else set()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            a, b = [], []
            for x, y, tx, ty in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), _texts(batch["ta"]), _texts(batch["tb"])):
                if x != last:
                    last, held = x, shingles(tx)
                other = shingles(ty)
                both = len(held & other)
                if both and 100 * both >= percent * (len(held) + len(other) - both):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        give_back()

    return run


def _need(n: Column, k: int, need: int, percent: int) -> Column:
    """How many retained values a text of n shingles surely shares with a linked one."""
    return F.when(n * 100 <= k * percent, F.ceil(n * percent / 100)).otherwise(need).cast("int")


def link_classes(docs: DataFrame, *, words: int = 5, percent: int = 80, k: int = K, need: int = NEED, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, labels): rows has rid, id, n, rep of each row of ``docs``; labels has node and root of linked texts.

    rep is the row id of the first row with the same text. Texts are linked when the Jaccard
    similarity of their shingle sets is at least ``percent`` hundredths.
    """
    mine = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", mine.schema["id"].dataType), *T._parse_datatype_string(_SKETCH).fields])
    base = cut(mine.mapInArrow(_sketcher(words, k), schema))
    reps = base.groupBy("key").agg(F.min("rid").alias("rep"))
    rows = cut(base.select("rid", "id", "n", "key").join(reps, "key").select("rid", "id", "n", "rep", "key"))
    nodes = cut(base.join(rows.where("rid = rep and n > 0").select("rid"), "rid", "left_semi").select(F.col("rid").alias("node"), "key", "n", "s1", "s2", "s3", "s4", "odd", "sketch"))
    del base, reps
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine = _shared(nodes.select("node", F.explode("sketch").alias("v")), parts).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("l"))
    facts = nodes.select("node", "n", "s1", "s2", F.size("sketch").alias("m"))
    kept = F.col("m") - _need(F.col("n"), k, need, percent) + 1
    # Values that no other text retains are the rarest of all and take the first places.
    kept = F.greatest(kept - (F.col("m") - F.size("l")), F.lit(0))
    prefixes = cut(mine.join(facts, "node").select("node", "n", "s1", "s2", F.transform(F.slice("l", 1, kept), lambda e: e["v"]).alias("pre")).where(F.size("pre") > 0))
    # Dealt by value, the lists are joined by value without moving again; their counts move values alone.
    lists = prefixes.select("node", "n", "s1", "s2", F.explode("pre").alias("v")).repartition(parts, "v")
    lists = lists.join(lists.groupBy("v").agg(F.count("*").alias("size")).where("size > 1"), "v")
    pair = [F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")]
    other = lambda df, *more: df.select("v", *[F.col(c).alias(c + "_") for c in ("node", "n", "s1", "s2", *more)])
    check = lambda pairs: confirm(pairs.distinct(), nodes, docs, words, percent, k, need, text_col)
    short = lists.where(F.col("size") <= SHORT_LIST).drop("size")
    close = short.join(other(short), "v").where((F.col("node") < F.col("node_")) & _alike(2, FEW_BITS, percent)).select(*pair)
    rest_of = nodes.select(F.col("node").alias("m"), "s3", "s4", "odd")
    long_ = cut(lists.where(F.col("size") > SHORT_LIST).drop("size").join(rest_of, F.col("node") == F.col("m")).drop("m"))
    alike = _alike(4, MANY_BITS, percent) & (_odd_bits() * (100 + percent) <= (F.col("n") + F.col("n_")) * (100 - percent))
    facts_of = ["node", "n", "s1", "s2", "s3", "s4", "odd"]
    heads = long_.groupBy("v").agg(*[F.min_by(c, "node").alias(c + "_") for c in facts_of])
    starred = long_.join(heads, "v").where((F.col("node") != F.col("node_")) & alike).select(*pair)
    links = check(close.unionByName(starred))
    labels = connected_components(links, arrow=True)
    if long_.isEmpty():
        return rows, labels
    grouped = lambda labels: long_.join(labels, "node", "left").withColumn("g", F.coalesce("root", "node")).drop("root")
    mixed_of = lambda df: df.join(df.groupBy("v").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 < g1").select("v"), "v", "left_semi")
    # Each text meets HEADS others of the first of its lists that hold several groups still.
    mixed = cut(mixed_of(grouped(labels)).select("v", *facts_of, "g"))
    drawn = mixed.groupBy("v").agg(F.array_distinct(F.array(*[F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(HEADS)])).alias("heads"))
    one = mixed.groupBy("node").agg(F.min("v").alias("v")).join(drawn, "v").select("node", F.explode("heads").alias("node_"))
    heads = mixed.join(drawn.select(F.explode("heads").alias("node")).distinct(), "node", "left_semi").select(*[F.col(c).alias(c + "_") for c in (*facts_of, "g")]).dropDuplicates(["node_"])
    each = mixed.select(*facts_of, "g").dropDuplicates(["node"])
    met = one.join(heads, "node_").join(each, "node").where((F.col("g") != F.col("g_")) & alike).select(*pair)
    links = cut(links.unionByName(check(met)))
    labels = connected_components(links, arrow=True)
    # What is in different groups still is compared in cells, each pair in its first common list.
    known = mixed_of(grouped(labels)).join(prefixes.select("node", "pre"), "node").select("v", *facts_of, "g", "pre")
    rest = _cells(cut(known), alike).select(*pair)
    return rows, connected_components(links.unionByName(check(rest)), arrow=True)


def _shared(values: DataFrame, parts: int) -> DataFrame:
    """The rows (node, v) whose v occurs more than once, and how often (df).

    They are dealt by v once: the count names both columns, since a count of rows would need v alone, which Spark would deal a second time.
    """
    dealt = values.repartition(parts, "v")
    return dealt.join(dealt.groupBy("v").agg(F.count(F.coalesce("v", "node")).alias("df")).where("df > 1"), "v")


def _odd_bits() -> Column:
    """How many bits of a row's odd sketch differ from its partner's: at most as many as the sets' difference."""
    return sum((F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("odd_")[i])) for i in range(ODD_BITS // 64)), F.lit(0))


def _cells(members: DataFrame, alike: Column) -> DataFrame:
    """Pairs (node, node_) of different groups g that share a list v and are ``alike``, each in its first common list.

    A list's largest group needs no comparison inside, so only its other members, in cells, meet all cells.
    """
    sizes = members.groupBy("v", "g").agg(F.count("*").alias("c"))
    sizes = sizes.groupBy("v").agg(F.max_by("g", F.struct("c", "g")).alias("core"), F.max("c").alias("most"), F.sum("c").alias("all"))
    cells = lambda n: F.greatest(F.ceil(n / CELL), F.lit(1)).cast("int")
    sizes = sizes.select("v", "core", cells(F.col("all") - F.col("most")).alias("few"), cells(F.col("most")).alias("many"))
    dealt = members.join(sizes, "v").withColumn("rest", F.col("g") != F.col("core"))
    dealt = dealt.withColumn("cell", F.when(F.col("rest"), F.pmod(F.xxhash64("node"), F.col("few"))).otherwise(F.col("few") + F.pmod(F.xxhash64("node"), F.col("many"))).cast("int"))
    names = ["node", "n", "s1", "s2", "s3", "s4", "odd", "g", "pre"]
    left = dealt.where("rest").withColumn("with", F.explode(F.sequence(F.col("cell"), F.col("few") + F.col("many") - 1))).select("v", F.col("cell").alias("i"), F.col("with").alias("j"), *names)
    most = F.when(F.col("rest"), F.col("cell")).otherwise(F.col("few") - 1)
    right = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), most))).select("v", F.col("with").alias("i"), F.col("cell").alias("j"), *[F.col(c).alias(c + "_") for c in names])
    first = F.array_min(F.array_intersect("pre", "pre_")) == F.col("v")
    once = (F.col("i") < F.col("j")) | (F.col("node") < F.col("node_"))
    return left.join(right, ["v", "i", "j"]).where(once & (F.col("g") != F.col("g_")) & alike & first).select("node", "node_")


def _alike(longs: int, most: int, percent: int) -> Column:
    """Whether sizes and signatures of a row and its partner, whose columns end in _, allow the similarity."""
    bits = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"s{i}_"))) for i in range(1, longs + 1)), F.lit(0))
    return (F.least("n", "n_") * 100 >= F.greatest("n", "n_") * percent) & (bits <= most)


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int, k: int, need: int, text_col: str) -> DataFrame:
    """(a, b): the pairs whose union sketch allows the similarity and whose full sets confirm it."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS))
    # Only texts whose bucket has a pair are moved.
    pairs = cut(pairs)
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).select(bucket("node").alias("bucket")).distinct()
    sketches = nodes.select("node", "n", "sketch", "key").withColumn("bucket", bucket("node")).join(F.broadcast(asked), "bucket", "left_semi").drop("bucket")
    both = pairs.join(sketches.toDF("a", "na", "sa", "ka"), "a").join(sketches.toDF("b", "nb", "sb", "kb"), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    seen = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    least = F.least(F.lit(need), F.ceil(F.size(union) * need / k))
    pairs = cut(both.where(seen >= least).select("a", "b", "ka", "kb"))
    wanted = pairs.select(F.explode(F.array("ka", "kb")).alias("key"))
    near = wanted.select(bucket("key").alias("bucket")).distinct()
    texts = docs.select(F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("key"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("bucket", bucket("key")).join(F.broadcast(near), "bucket", "left_semi").select("key", "text").dropDuplicates(["key"])
    rows = pairs.join(texts.toDF("ka", "ta"), "ka").join(texts.toDF("kb", "tb"), "kb").select("a", "b", "ta", "tb")
    return cut(rows.mapInArrow(_verifier(words, percent), "a long, b long"))


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept, key (the text's MD5), group.

    A null, empty or blank text has no shingles and is linked with nothing: it is its own
    component. Rows with a null id take part; a component without any id has the null id.
    kept marks rows whose id is their component's, so rows that repeat that id are all marked.
    group tells components apart, which ids don't where they are null or repeated: linked and equal texts share it.
    """
    rows, labels = link_classes(docs, **how)
    nodes = rows.where("n > 0").groupBy("rep").agg(F.min("id").alias("least")).join(labels, F.col("rep") == F.col("node"), "left").select("rep", "least", "root")
    tops = nodes.where("root is not null").groupBy("root").agg(F.min("least").alias("top"))
    nodes = nodes.join(tops, "root", "left").select("rep", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("top")).alias("component"), F.coalesce("root", "rep").alias("group"))
    out = rows.join(nodes, "rep", "left").withColumn("component_id", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")))
    return out.select("id", F.col("n").cast("long").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "key", F.coalesce("group", "rep").alias("group"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each near-duplicate component; blank texts all stay; columns as they are."""
    inner, (id_, text_) = shielded(docs, id_col, text_col)
    found = near_duplicates(inner, id_col=id_, text_col=text_, **how)
    best = found.where("kept and n_shingles > 0").groupBy("group", "component_id").agg(F.min("key").alias("best"))
    text = F.col(text_).cast("string")
    mine = inner.withColumn("k", F.unhex(F.md5(F.coalesce(text, F.lit(""))))).withColumn("full", F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    rest = mine.where("full").join(best, F.col(id_).eqNullSafe(F.col("component_id")) & (F.col("k") == F.col("best")), "left_semi").dropDuplicates([id_, "k"])
    return rest.unionByName(mine.where("not full")).select(*inner.columns).toDF(*docs.columns)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: distinct 2-word shingles, component of documents at Jaccard 0.8, whether it is kept."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


QUERIES = {"op2_near_dedup": op2_near_dedup}
ORACLES = {
    "op2_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 2) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a),
k AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN k ON k.x = d.doc_id"""
}
