"""Counts, rates, concentrations and similarity: keyed aggregations with explicit tie orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, *cols: str, n: str = "n") -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(*cols).agg(F.count("*").alias(n))


def top_k(df: DataFrame, col: str, k: int, *, n: str = "n") -> DataFrame:
    """The k most frequent values, ties to the smaller value; only this report is limited."""
    return value_counts(df, col, n=n).orderBy(F.desc(n), col).limit(k)


def scale_counts(df: DataFrame, col: str, scale: Sequence[str], *, keep_zero: bool = True, n: str = "n") -> DataFrame:
    """(pos, term, n) for every term of an ordered scale; terms without rows have 0 or are dropped."""
    terms = df.sparkSession.createDataFrame(list(enumerate(scale)), "pos int, term string")
    got = value_counts(df.where(F.col(col).isin(*scale)), col, n=n)
    out = F.broadcast(terms).join(got, terms.term == got[col], "left" if keep_zero else "inner") if not keep_zero else terms.join(got, terms.term == got[col], "left")
    return out.select("pos", "term", F.coalesce(n, F.lit(0)).cast("long").alias(n))


def crosstab(df: DataFrame, row: str, col: str, rows: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A row for each of ``rows`` with a count for each of ``cols``, 0 where there is none."""
    got = df.where(F.col(row).isin(*rows)).groupBy(row).pivot(col, list(cols)).count()
    base = df.sparkSession.createDataFrame([(r,) for r in rows], "__r string")
    return base.join(got, F.col("__r") == F.col(row), "left").select(F.col("__r").alias(row), *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(c) for c in cols])


def part_counts(df: DataFrame, col: str, separator: str, *, n: str = "n") -> DataFrame:
    """Counts of the non-empty parts of a multi-valued text."""
    parts = df.select(F.explode(F.split(col, separator)).alias("part")).select(F.trim("part").alias("part"))
    return value_counts(parts.where("part != ''"), "part", n=n)


def group_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: groups, mean and median of the rows per group, the median's whole part, largest and smallest group (ties to the smaller key)."""
    g = df.groupBy(key).agg(F.count("*").alias("n"))
    return g.agg(F.count("*").alias("groups"), F.round(F.avg("n"), 6).alias("mean"), F.median("n").cast("double").alias("median"), F.floor(F.median("n")).cast("long").alias("median_int"), F.min_by(key, F.struct(-F.col("n"), F.col(key))).alias("largest"), F.min_by(key, F.struct(F.col("n"), F.col(key))).alias("smallest"))


def concentration(df: DataFrame, key: str, share: float) -> DataFrame:
    """One row: groups, k = max(1, floor(share x groups)), rows in the k largest groups and their part of all.

    Counts of counts are cumulated instead of ranking every group: the ordered window holds one row for each distinct group size.
    """
    g = df.groupBy(key).agg(F.count("*").alias("n"))
    sizes = g.groupBy("n").agg(F.count("*").alias("m"))
    w = Window.orderBy(F.desc("n"))
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.withColumn("groups", F.sum("m").over(whole)).withColumn("before", F.coalesce(F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("k", F.greatest(F.lit(1).cast("long"), F.floor(F.col("groups") * share + 1e-9)))
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("m"), F.col("k") - F.col("before")))
    return s.agg(F.max("groups").alias("groups"), F.max("k").alias("k"), F.sum(taken * F.col("n")).alias("top_rows"), F.round(F.sum(taken * F.col("n")) / F.sum(F.col("m") * F.col("n")), 6).alias("top_share"))


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the number of distinct pairs of non-null values."""
    return df.agg(F.count_distinct(a, b).alias("n"))


def only_value(df: DataFrame, key: str, col: str, value: str) -> DataFrame:
    """The keys all of whose values are the one given."""
    return df.groupBy(key).agg(F.min(col).alias("lo"), F.max(col).alias("hi")).where((F.col("lo") == value) & (F.col("hi") == value)).select(key)


def breakdown(df: DataFrame, key: str, col: str) -> DataFrame:
    """(key, breakdown): a JSON object of counts by value, its keys sorted."""
    g = df.groupBy(key, col).agg(F.count("*").alias("n"))
    return g.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(col, "n"))))).alias("breakdown"))


def monthly(df: DataFrame, month: Column, *, n: str = "n") -> DataFrame:
    """Rows per month text; null months are left out."""
    return df.select(month.alias("month")).where("month is not null").groupBy("month").agg(F.count("*").alias(n))


def jaccard(df: DataFrame, key: str, item: str) -> DataFrame:
    """(a, b, common, jaccard) for the pairs of keys with an item in common, a <= b.

    Keys meet through their items, so pairs without one are never made.
    """
    s = df.select(F.col(key).alias("k"), F.col(item).alias("i")).where("k is not null and i is not null").distinct()
    n = s.groupBy("k").agg(F.count("*").alias("n"))
    pairs = s.toDF("a", "i").join(s.toDF("b", "i"), "i").where("a <= b").groupBy("a", "b").agg(F.count("*").alias("common"))
    out = pairs.join(n.toDF("a", "na"), "a").join(n.toDF("b", "nb"), "b")
    return out.select("a", "b", "common", F.round(F.col("common") / (F.col("na") + F.col("nb") - F.col("common")), 6).alias("jaccard"))


def missing_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, missing, rate): null or blank values of each column, all from one scan."""
    blank = lambda c: F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""))
    one = df.agg(F.count("*").alias("__n"), *[blank(c).alias(c) for c in cols])
    long = one.unpivot(["__n"], list(cols), "column", "missing")
    return long.select("column", "missing", F.round(F.col("missing") / F.col("__n"), 6).alias("rate"))


def repeated_texts(df: DataFrame, text: str, group: str, least: int) -> DataFrame:
    """The rows of ``df`` whose non-empty text stands in ``least`` groups or more."""
    often = df.where(F.col(text) != "").groupBy(text).agg(F.count_distinct(group).alias("g")).where(F.col("g") >= least).select(text)
    return df.join(often, text, "left_semi")


def indicators(df: DataFrame, **tests: Column) -> DataFrame:
    """One row with a count for each test, all from one scan."""
    return df.agg(*[F.count_if(t).alias(name) for name, t in tests.items()])


def rates(df: DataFrame, **tests: Column) -> DataFrame:
    """(name, ok, total, rate) for each test, from one scan; a null test is no success."""
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(t).alias(name) for name, t in tests.items()])
    long = one.unpivot(["__n"], list(tests), "name", "ok")
    return long.select("name", "ok", F.col("__n").alias("total"), F.round(F.coalesce(F.try_divide("ok", "__n"), F.lit(0.0)), 6).alias("rate"))


def keyed_json(df: DataFrame, key: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(key, total, entries): each key's rows as a JSON array in the given order."""
    rows = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*fields).alias("e"))))
    return df.groupBy(key).agg(F.count("*").alias("total"), F.to_json(F.transform(rows, lambda x: x["e"])).alias("entries"))
