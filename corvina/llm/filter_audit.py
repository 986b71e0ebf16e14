"""What each of several filters costs, alone and after the others, by inclusion-exclusion.

Each document becomes one bit per failed filter. From the counts of documents that fail all of
a set of filters together (one count for each of the 2^k sets, as sums of products of the
flags) everything else follows by alternating sums, with no further look at a document: what an
order of filters keeps and removes at each step, what only one filter would catch, and each
filter's Shapley value, whose Harsanyi dividends are the joint counts with alternating sign.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.llm.common import DARK, cut

#: The filters' letters, in the order of their bits.
FILTERS = "ABCDE"
#: Weights of a document in the joint counts: itself, whether it is good, whether it is toxic.
WEIGHTS = ("n", "good", "toxic")


def text_flags(text: Column) -> Column:
    """Bits of the four filters that look at one text (null is empty): A under 200 words, B under half of the words
    distinct, C over 3 % capitals A-Z, D any of ``#$%&*|``."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({DARK})"), F.lit(1))
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))

    def bits(w: Column) -> Column:
        few = F.size(w) < 200
        repeated = F.size(F.array_distinct(w)).cast("long") * 100 < F.size(w).cast("long") * 50
        loud = capitals.cast("long") * 100 > F.char_length(text).cast("long") * 3
        flags = (few, repeated, loud, text.rlike("[#$%&*|]"))
        return reduce(lambda a, b: a + b, [f.cast("int") * (1 << i) for i, f in enumerate(flags)])

    return F.element_at(F.transform(F.array(words), bits), 1)


def failures(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part that fail exactly the filters in mask, and how many are labelled good or toxic.

    The fifth filter, E, fails a text that some smaller id of the whole table has too; null texts are empty, a null id is
    neither smaller nor larger, and of rows that share text and smallest id none fails. Null parts are the empty string.
    Of repeated labels of one id the larger counts; a document without labels is neither good nor toxic.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_flags(text).alias("mask")))
    # The join's key is text and id together, so a text with very many copies is spread by their ids.
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("first"))
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(*[F.max((F.col(c) == 1).cast("int")).alias(w) for c, w in (("quality", "good"), ("toxic", "toxic"))])
    rows = rows.join(first.withColumnRenamed("digest", "d"), (F.col("digest") == F.col("d")) & (F.col("id") == F.col("first")), "left")
    again = F.col("id").isNotNull() & F.col("first").isNull()
    rows = rows.select("id", "part", (F.col("mask") + again.cast("int") * (1 << 4)).alias("mask"))
    rows = rows.join(known, F.col("id") == F.col("labelled"), "left")
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), *[F.coalesce(F.sum(w), F.lit(0)).cast("long").alias(w) for w in WEIGHTS[1:]])


def joint_counts(failed: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """(part, n, good, toxic): for each weight an array whose element at a set's bits counts the documents that fail every filter of the set."""

    def joint(weight: str, those: int) -> Column:
        flags = [F.getbit("mask", F.lit(i)).cast("long") for i in range(filters) if those >> i & 1]
        return F.sum(reduce(lambda a, b: a * b, flags, F.col(weight)))

    return failed.groupBy("part").agg(*[F.array(*[joint(w, those) for those in range(1 << filters)]).alias(w) for w in WEIGHTS])


def _alternating(joint: str, filter_: str, others: str, filters: int) -> Column:
    """Documents that fail ``filter_`` (a set's bits, 0 for all documents) and none of ``others``."""
    return F.expr(f"aggregate(sequence(0, {(1 << filters) - 1}), 0L, (s, t) -> s + IF((t & {others}) = t, IF(bit_count(t) % 2 = 0, 1L, -1L) * {joint}[t | {filter_}], 0L))")


def step_counts(joint: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """(part, filter, before, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for each filter and each set of others applied before it.

    filter is its bit's number, before the set's bits. shapley is the filter's share summed over all orders: k!/|T| of the
    dividend of every set T that it is in.
    """
    top = (1 << filters) - 1
    sets = [(f, 1 << f, p) for f in range(filters) for p in range(1 << filters) if not p >> f & 1]
    rows = joint.select("part", *WEIGHTS, F.explode(F.from_json(F.lit(str([{"filter": f, "bit": b, "before": p} for f, b, p in sets]).replace("'", '"')), "array<struct<filter:int,bit:int,before:int>>")).alias("s")).select("part", *WEIGHTS, "s.*")
    orders = math.factorial(filters)
    shapley = F.expr(f"aggregate(sequence(1, {top}), 0L, (s, t) -> s + IF((t & bit) = 0, 0L, IF(bit_count(t) % 2 = 1, 1L, -1L) * n[t] * ({orders} div bit_count(t))))")
    removed = lambda w: _alternating(w, "bit", "before", filters)
    return rows.select(
        "part", "filter", "before", _alternating("n", "0", "(before | bit)", filters).alias("kept"), removed("n").alias("removed"), (F.expr("n[bit]") - removed("n")).alias("redundant"),
        _alternating("n", "bit", f"({top} ^ bit)", filters).alias("unique_fails"), removed("good").alias("good_lost"), removed("toxic").alias("toxic_lost"), shapley.cast("long").alias("shapley"),
    )


def orders(spark: SparkSession, letters: str = FILTERS) -> DataFrame:
    """(filter_order, step, filter, before): every order of the filters, step by step."""
    rows = [("".join(letters[i] for i in order), k + 1, f, sum(1 << i for i in order[:k])) for order in permutations(range(len(letters))) for k, f in enumerate(order)]
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, before int")


def audit(docs: DataFrame, labels: DataFrame, **cols: str) -> DataFrame:
    """One row per part, order of the five filters and step: what the step keeps, removes and would have caught; see ``failures`` and ``step_counts``. No documents give no rows."""
    steps = step_counts(joint_counts(failures(docs, labels, **cols)))
    return orders(docs.sparkSession).join(steps, ["filter", "before"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all ``documents`` per language."""
    return audit(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))


QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLES = {
    "op11_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b, 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic
      FROM t LEFT JOIN l USING (doc_id)),
g AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed,
             count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
f AS (SELECT part, filter_order, step, filter_order[step] AS filter, n, good, toxic, contains(failed, filter_order[step]) AS fails, failed = filter_order[step] AS only_this,
             len(list_filter(range(1, step), lambda i: contains(failed, filter_order[i]))) > 0 AS gone FROM g, s),
r AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed, coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
             coalesce(sum(n) FILTER (only_this), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
      FROM f GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r"""
}
