"""Checks as rows, constraint violations, and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(AssertionError):
    """A check of the gate didn't pass."""


def checks(df: DataFrame, limits: Mapping[str, tuple[str, float]], **figures: Column) -> DataFrame:
    """(name, kind, bound, actual, passed) for aggregate figures of ``df``; kind is max or min."""
    one = df.agg(*[f.cast("double").alias(name) for name, f in figures.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(limits[n][0]).alias("kind"), F.lit(float(limits[n][1])).alias("bound"), F.round(F.coalesce(n, F.lit(0.0)), 6).alias("actual")) for n in figures])
    out = one.select(F.explode(rows).alias("c")).select("c.*")
    return out.withColumn("passed", F.when(F.col("kind") == "max", F.col("actual") <= F.col("bound")).otherwise(F.col("actual") >= F.col("bound")))


def gate(report: DataFrame) -> None:
    """Raise GateError naming the checks that didn't pass; reads the report's few rows."""
    if failed := [r["name"] for r in report.where("not passed").select("name").collect()]:
        raise GateError(", ".join(sorted(failed)))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """(key, n) of keys that more than one row has."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, ref: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference no parent has."""
    return df.where(F.col(ref).isNotNull()).join(parents.select(F.col(key).alias("__k")), F.col(ref) == F.col("__k"), "left_anti")


def violations(df: DataFrame, *, required: Sequence[str] = (), enums: Mapping[str, Sequence[str]] | None = None, ranges: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """(column, rule, n) of broken rules, from one scan; kept rules have no row. Null breaks ``required`` only."""
    tests = {f"{c}|required": F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in required}
    tests |= {f"{c}|enum": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in (enums or {}).items()}
    tests |= {f"{c}|range": F.col(c).isNotNull() & ~F.col(c).between(*v) for c, v in (ranges or {}).items()}
    one = df.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    long = one.unpivot([], list(tests), "k", "n").where("n > 0")
    return long.select(F.split_part("k", F.lit("|"), F.lit(1)).alias("column"), F.split_part("k", F.lit("|"), F.lit(2)).alias("rule"), "n")


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether both hold the same rows, repeats counted."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def fingerprint(df: DataFrame, *cols: str) -> DataFrame:
    """One row (n, fingerprint): an order-free hash of the rows, from partial sums instead of one long list.

    It is the sum of the first 15 hexadecimal digits of each row's MD5, as decimal text; rows are the columns'
    texts joined by a bar, null written empty.
    """
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    part = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(part).cast("string"), F.lit("0")).alias("fingerprint"))
