"""Benchmark decontamination with DataFrame functions only.

A benchmark item's windows are its runs of ``window`` consecutive normalised words (all its
words, where it has fewer). The seeds of a window of L words are its runs of ceil(L / 2)
words; any occurrence of the window in a document contains a seed that starts at a
multiple of L - ceil(L / 2) + 1, so documents look up only every such position in the
broadcast hash set of seeds. The few hits are verified against the windows' full wording.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.llm.common import NOT_WORD, cut, shielded, word_array

#: Windows broadcast at once (about 100 bytes and up to 6 seeds each); more go in blocks, one scan of the documents each.
BLOCK_WINDOWS = 200_000


def benchmark_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(win, n, items): each distinct window, its words and the ids of its items."""
    words = benchmark.select(F.col(item_col).alias("item"), word_array(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("w") - n + 1)
    each = words.select("item", n.alias("n"), F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("win"))
    return each.groupBy("win", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _half(n: Column) -> Column:
    return F.floor((n + 1) / 2).cast("int")


def _seeds(windows: DataFrame) -> DataFrame:
    """(code): hashes of the windows' seeds."""
    n = F.col("n")
    at = F.explode(F.sequence(F.lit(1), n - _half(n) + 1)).alias("at")
    return windows.select("n", F.split("win", " ").alias("w"), at).select(F.xxhash64("n", F.slice("w", F.col("at"), _half(n))).alias("code")).distinct()


def find_windows(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per distinct (id, text) of ``docs``: id, code, copies, n_words, n_hit, items, spans.

    code is the text's xxhash64; copies counts the rows with that id and text; spans holds
    the merged hit runs as (start, end) word positions, end excluded; items holds the ids of
    the items with occurring windows, null ids left out. A null or wordless text has 0 words and
    no hits; null document ids are kept; items without words have no windows.
    """
    windows = cut(benchmark_windows(benchmark, window, item_col, item_text_col))
    lengths = {r[0]: r[1] for r in windows.groupBy("n").count().collect()}  # at most ``window`` rows
    blocks = max(1, math.ceil(sum(lengths.values()) / block_windows))
    text = F.col(text_col)
    words = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("code"), word_array(text).alias("w"))

    def places(n: int) -> Column:
        half = (n + 1) // 2
        some = F.transform(F.sequence(F.lit(0), F.size("w") - half, F.lit(n - half + 1)), lambda j: F.struct(j.alias("j"), F.lit(n).alias("n")))
        return F.when(F.size("w") >= n, some).otherwise(F.array().cast("array<struct<j:int,n:int>>"))

    flows = []
    for k in range(blocks):
        block = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == k)
        first = [F.array(F.struct(F.lit(-1).alias("j"), F.lit(0).alias("n")))] if k == 0 else []
        each = words.select("id", "code", "w", F.explode(F.concat(*first, *map(places, sorted(lengths)), F.array().cast("array<struct<j:int,n:int>>"))).alias("p"))
        each = each.select("id", "code", "w", "p.j", "p.n", F.when(F.col("p.j") >= 0, F.xxhash64("p.n", F.slice("w", F.col("p.j") + 1, _half(F.col("p.n"))))).alias("seed"))
        seeds = _seeds(block).select(F.col("code").alias("seed"), F.lit(True).alias("found"))
        near = each.join(F.broadcast(seeds), "seed", "left").where("j < 0 or found")
        low = F.greatest(F.col("j") - (F.col("n") - _half(F.col("n"))), F.lit(0))
        high = F.least(F.col("j"), F.size("w") - F.col("n"))
        starts = F.when((F.col("j") >= 0) & (low <= high), F.transform(F.sequence(low, high), lambda i: F.struct(i.alias("i"), F.array_join(F.slice("w", i + 1, F.col("n")), " ").alias("win"))))
        near = near.select("id", "code", "j", "n", F.when(F.col("j") < 0, F.size("w")).alias("n_words"), F.explode_outer(starts).alias("s"))
        near = near.select("id", "code", "j", "n", "n_words", "s.i", "s.win")
        flows.append(near.join(F.broadcast(block.select("win", "items")), "win", "left").where("j < 0 or items is not null").select("id", "code", "j", "n", "i", "n_words", "items"))
    rows = flows[0]
    for flow in flows[1:]:
        rows = rows.unionByName(flow)
    found = rows.groupBy("id", "code").agg(
        F.count_if(F.col("j") < 0).alias("copies"),
        F.coalesce(F.max("n_words"), F.lit(0)).cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("j") >= 0, F.struct(F.col("i").alias("start"), (F.col("i") + F.col("n")).alias("end"))))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def merge(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when(F.size(acc) == 0, F.array(x)).when(x["start"] <= last["end"], joined).otherwise(F.concat(acc, F.array(x)))

    spans = F.when(F.size("hits") == 0, empty).otherwise(F.aggregate("hits", empty, merge))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return found.select("id", "code", "copies", "n_words", "items", spans.alias("spans")).withColumn("n_hit", n_hit)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, mode: str = "documents", max_share: float = 0.0, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without what it shares with the benchmark; its columns stay as they are.

    mode "documents" drops each document with more than ``max_share`` of its words hit;
    mode "spans" keeps every document and removes the hit words, each with the separators
    after it. Null texts and texts without words are never hit. Rows with equal id and
    text share one decision.
    """
    inner, (id_, text_) = shielded(docs, id_col, text_col)
    found = find_windows(inner, benchmark, id_col=id_, text_col=text_, **how).where("n_hit > 0")
    found = found.select("id", "code", "spans", (F.col("n_hit") / F.col("n_words")).alias("share"))
    same = F.col(id_).eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce(F.col(text_), F.lit(""))) == F.col("code"))
    if mode == "documents":
        return inner.join(found.where(F.col("share") > max_share), same, "left_anti").toDF(*docs.columns)
    if mode != "spans":
        raise ValueError(f"mode must be documents or spans, not {mode!r}")
    word = NOT_WORD.replace("[", "[^", 1).replace("\\x3A-\\x60", "\\x3A-\\x40\\x5B-\\x60")
    parts = F.regexp_extract_all(F.col(text_), F.lit(f"{word}(?:(?!{word})[\\s\\S])*"), F.lit(0))
    kept = F.filter(parts, lambda x, i: ~F.exists("spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    lead = F.regexp_extract(F.col(text_), f"^(?:(?!{word})[\\s\\S])*", 0)
    clean = F.when(F.col("spans").isNull(), F.col(text_)).otherwise(F.concat(lead, F.array_join(kept, "")))
    return inner.join(found, same, "left").select(*[clean.alias(c) if c == text_ else F.col(c) for c in inner.columns]).toDF(*docs.columns)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside benchmark windows, items found and the digest of their ids."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = find_windows(docs, benchmark)
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    ).drop("copy")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLES = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, win)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)"""
}
