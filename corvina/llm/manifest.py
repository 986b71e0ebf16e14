"""A Merkle manifest: digests of rows, of each part of a table, and of the whole, with proofs.

Rows are numbered within their part and dealt to aligned buckets of 2^k consecutive ones.
An executor folds a bucket level by level with DuckDB queries and keeps each row's siblings;
bucket roots are the next stage's rows, until every part has one root. The parts' roots are
folded in the same way. A row's proof is its siblings within its bucket and then its
bucket's proof.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvina.llm.common import cut

#: A bucket holds 2^BUCKET_LEVELS consecutive nodes of a tree.
BUCKET_LEVELS = 12
PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
PATH_DDL = "array<struct<before:string,after:string>>"


def leaf_digest(*values: Column) -> Column:
    """sha256, as lowercase hex, of the values one after the other: ``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """``rows`` with pos, each one's place in its tree from 0 by ``order``, and n, the tree's rows.

    Rows are sorted over the cluster and numbered by their place in a partition, the tree's rows in the partitions
    before it added; only one small row per tree and partition meets the window.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows are told apart by where they are read, so that they needn't meet in one partition.
    by = (tree, *order, "__at")
    placed = rows.withColumn("__at", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("__at")
    placed = cut(placed).withColumn("__row", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__row", 33))
    runs = placed.groupBy(tree, "__part").agg(F.min("__row").alias("__low"), F.count("*").alias("__n"))
    every = Window.partitionBy(tree)
    before = F.coalesce(F.sum("__n").over(every.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(tree, "__part", (before - F.col("__low")).alias("__shift"), F.sum("__n").over(every).alias("n"))
    return placed.join(runs, [tree, "__part"]).withColumn("pos", F.col("__row") + F.col("__shift")).drop("__row", "__part", "__shift")


def _fold_bucket(bits: int):
    """Folds one bucket of a tree with DuckDB: its nodes with their siblings level by level, and its root."""

    def run(table: pa.Table) -> pa.Table:
        import duckdb

        table = table.sort_by("pos")
        n = table["n"][0].as_py()
        levels = bits if n > 1 << bits else (n - 1).bit_length()
        db = duckdb.connect(config={"threads": 1})
        try:
            db.register("bucket", table.select(["pos", "h"]))
            db.execute(f"CREATE TABLE nodes AS SELECT 0 AS level, pos & {(1 << bits) - 1} AS i, h FROM bucket")
            for k in range(levels):
                db.execute(f"INSERT INTO nodes SELECT {k + 1}, i >> 1, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE level = {k} GROUP BY i >> 1")
            paths = db.sql(
                f"""WITH steps AS (SELECT i AS leaf, unnest(range({levels})) AS up FROM nodes WHERE level = 0)
                    SELECT list({{'before': CASE WHEN (leaf >> up) & 1 = 1 THEN coalesce(h, '') ELSE '' END, 'after': CASE WHEN (leaf >> up) & 1 = 0 THEN coalesce(h, '') ELSE '' END}} ORDER BY up) AS path
                    FROM steps LEFT JOIN nodes ON level = up AND i = xor(leaf >> up, 1) GROUP BY leaf ORDER BY leaf"""
            ).to_arrow_table()
            root = db.execute(f"SELECT h FROM nodes WHERE level = {levels}").fetchall()
        finally:
            db.close()
        if len(root) != 1 or levels and paths.num_rows != table.num_rows:
            raise ValueError("the places of a bucket's nodes are not consecutive")
        path = paths["path"].combine_chunks().cast(PATH) if levels else pa.array([[]], PATH)
        return table.append_column("path", path).append_column("root", pa.array([root[0][0]] * len(path), pa.string()))

    return run


def _climb(nodes: DataFrame, bits: int, top) -> DataFrame:
    """``nodes`` (tree, pos, n, h and others) with path, the siblings up to the end, root, the tree's, and what ``top`` adds.

    ``top`` gets one row (tree, root) per tree and returns it with path, the siblings from there on, and more columns.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    spread = nodes.withColumn("bucket", F.shiftright("pos", bits))
    folded = cut(spread.groupBy("tree", "bucket").applyInArrow(_fold_bucket(bits), f"{kinds}, bucket long, path {PATH_DDL}, root string"))
    roots = folded.where(F.col("pos") == F.shiftleft("bucket", bits)).select("tree", F.col("bucket").alias("pos"), F.ceil(F.col("n") / (1 << bits)).alias("n"), F.col("root").alias("h"))
    if (folded.agg(F.max("n")).first()[0] or 0) > 1 << bits:
        above = _climb(roots, bits, top)
    else:
        above = top(roots.select("tree", F.col("h").alias("root"))).withColumn("pos", F.lit(0).cast("long"))
    above = above.drop("n", "h").withColumnRenamed("pos", "bucket").withColumnRenamed("path", "rest")
    joined = folded.drop("root").join(above, ["tree", "bucket"])
    return joined.withColumn("path", F.concat("path", "rest")).drop("bucket", "rest")


def merkle(leaves: DataFrame, *order: str, bits: int = BUCKET_LEVELS) -> DataFrame:
    """``leaves`` (tree, h and others) with pos, n, subroot (the tree's), root (of the subroots by tree) and path, the siblings from leaf to root.

    ``tree`` must not be null. A step of path has the digest to be put before and the one to be put after, empty where there
    is none; a step without either hashes the node alone. No leaves give no rows.
    """

    def forest(roots: DataFrame) -> DataFrame:
        trees = numbered(roots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("h")), "tree", "name")
        end = lambda r: r.withColumn("path", F.array().cast(PATH_DDL))
        return _climb(trees, bits, end).select(F.col("name").alias("tree"), F.col("h").alias("subroot"), "root", "path")

    return _climb(numbered(leaves, "tree", *order), bits, forest)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def manifest(docs: DataFrame, *, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), part_col: str = "lang", id_col: str = "doc_id", tamper: tuple[str, Column] | None = None, bits: int = BUCKET_LEVELS) -> DataFrame:
    """One row per document: its id, leaf, subroot, root, path, and what the leaf of possibly altered columns folds to.

    Leaves digest ``columns``; they ascend by id in each part, null ids first, rows of one id by their leaf; a null part is one
    of its own, the first. ``tamper`` is a column and what it is at the check instead; folded_root differs from root just
    where that changes the leaf. Long values are digested whole. No rows give none.
    """
    as_text = lambda c: F.col(c)
    checked = [tamper[1] if tamper and c == tamper[0] else as_text(c) for c in columns]
    tree = F.coalesce(F.concat(F.lit("="), F.col(part_col).cast("string")), F.lit(""))
    leaves = cut(docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf_digest(*map(as_text, columns)).alias("h"), leaf_digest(*checked).alias("checked")))
    got = merkle(leaves, "id", "h", bits=bits)
    return got.select(F.col("id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", "path", fold(F.col("checked"), F.col("path")).alias("folded_root"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; where 7 divides the CRC of the id, n_chars is one more at the check."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(odd, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    got = manifest(docs, tamper=("n_chars", n_chars))
    siblings = F.transform("path", lambda s: F.concat(s["before"], s["after"]))
    return got.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"


def _leaf_sql(n_chars: str) -> str:
    fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")
    return f"sha256({' || '.join(_FIELD.format(f) for f in fields)})"


#: CRC-32 of the decimal id, bit by bit: 8 steps for each byte.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
          lambda acc, b: list_reduce(list_prepend(xor(acc, b), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda s, i: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

QUERIES = {"op12_manifest": op12_manifest}
ORACLES = {
    "op12_manifest": f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS tampered FROM documents),
inner_tree AS (
  SELECT lang, 0 AS level, pos AS i, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, level + 1, i // 2, sha256(h || coalesce(after, '')), (n + 1) // 2
  FROM (SELECT *, lead(h) OVER (PARTITION BY lang ORDER BY i) AS after FROM inner_tree WHERE n > 1) WHERE i % 2 = 0),
subroots AS MATERIALIZED (SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM inner_tree WHERE n = 1),
outer_tree AS (
  SELECT 0 AS level, place AS i, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(h || coalesce(after, '')), (n + 1) // 2
  FROM (SELECT *, lead(h) OVER (ORDER BY i) AS after FROM outer_tree WHERE n > 1) WHERE i % 2 = 0),
top AS MATERIALIZED (SELECT h AS root, level AS height FROM outer_tree WHERE n = 1),
nodes AS MATERIALIZED (SELECT coalesce('=' || lang, '') AS tree, level, i, h FROM inner_tree UNION ALL SELECT 'top', level, i, h FROM outer_tree),
paths AS MATERIALIZED (
  SELECT l.doc_id, l.lang, l.leaf, l.tampered, s.subroot, list_concat(
           [{{'tree': coalesce('=' || l.lang, ''), 'level': k, 'i': l.pos >> k, 'step': k}} FOR k IN range(s.height)],
           [{{'tree': 'top', 'level': k, 'i': s.place >> k, 'step': s.height + k}} FOR k IN range(t.height)]) AS steps
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang, top t),
each AS (SELECT doc_id, unnest(steps) AS s FROM paths),
siblings AS (SELECT doc_id, s.step AS step, s.i % 2 AS odd, coalesce(nodes.h, '') AS h FROM each LEFT JOIN nodes ON nodes.tree = s.tree AND nodes.level = s.level AND nodes.i = xor(s.i, 1)),
proofs AS MATERIALIZED (SELECT doc_id, sha256(string_agg(h, '' ORDER BY step)) AS proof_sha256, list(CASE WHEN odd = 1 THEN h ELSE '' END ORDER BY step) AS b, list(CASE WHEN odd = 0 THEN h ELSE '' END ORDER BY step) AS a FROM siblings GROUP BY doc_id),
folded AS (
  SELECT doc_id, tampered AS h, 1 AS k, b, a FROM paths JOIN proofs USING (doc_id)
  UNION ALL
  SELECT doc_id, sha256(b[k] || h || a[k]), k + 1, b, a FROM folded WHERE k <= len(b)),
ends AS (SELECT doc_id, h AS folded_root FROM folded WHERE k > len(b))
SELECT p.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, coalesce(folded_root, tampered) AS folded_root, coalesce(folded_root, tampered) = root AS verified
FROM paths p LEFT JOIN proofs USING (doc_id) LEFT JOIN ends USING (doc_id), top"""
}
