"""Review queues, buckets of doubtful values, and corrections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.text import contains_any, squeeze

COLUMNS = ("priority", "owner", "kind", "issue", "original_value", "current_value", "confidence")


def delivery_priority(reason: Column, confidence: Column) -> Column:
    """1 is most urgent: unknown terms 2 or 3 by confidence, cross-checks 3, doubtful matches 4, anything else 4."""
    r = F.lower(F.coalesce(reason, F.lit("")))
    return F.when(contains_any(r, ("não reconhecido", "unmatched")), F.when(confidence == "low", 2).otherwise(3)).when(r.contains("fuzzy"), 4).when(contains_any(r, ("cross-validation", "corrigido")), 3).otherwise(4)


def risk_priority(reason: Column, confidence: Column) -> Column:
    """Unknown terms 2 or 3 by confidence, anything else 4."""
    return F.when(F.lower(F.coalesce(reason, F.lit(""))).contains("não reconhecid"), F.when(confidence == "low", 2).otherwise(3)).otherwise(4)


def queue(*parts: DataFrame) -> DataFrame:
    """One queue of the parts' rows, each with the queue's columns."""
    out = parts[0].select(*COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*COLUMNS))
    return out


def buckets(df: DataFrame, *, field: str = "field", original: str = "original", group: str = "owner", order: str = "ord", examples: int = 5) -> DataFrame:
    """One row per (field, original) of non-blank values: rows, groups, score range, last method and match, first examples, impact.

    impact is the number of rows times what the smallest score lacks to 1. The examples are the first
    ``examples`` by order, a few rows of each bucket whatever its size.
    """
    mine = df.where(squeeze(F.col(original)) != "")
    w = Window.partitionBy(field, original).orderBy(order)
    first = mine.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= examples)
    first = first.groupBy(field, original).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("ord"), F.col(group).alias("owner"), F.col("context")))).alias("x"))
    first = first.select(field, original, F.array_join(F.transform("x", lambda e: F.concat(e["owner"], F.lit("/"), e["context"])), "; ").alias("examples"))
    agg = mine.groupBy(field, original).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(group)), ",").alias("groups"), F.min("score").alias("score_min"), F.max("score").alias("score_max"), F.max_by("method", order).alias("method"), F.max_by("match", order).alias("match"))
    return agg.join(first, [field, original]).withColumn("impact", F.round(F.col("n") * (1 - F.col("score_min")), 6))


def summaries(df: DataFrame, *cols: str) -> DataFrame:
    """(by, value, n): counts by each of the columns, from one pass with grouping sets."""
    sets = df.groupingSets([[c] for c in cols], *cols).agg(F.count("*").alias("n"), F.grouping_id().alias("__g"))
    by, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(cols):
        here = F.col("__g").bitwiseAND(F.lit(1 << (len(cols) - 1 - i))) == 0
        by, value = F.when(here, c).otherwise(by), F.when(here, F.col(c).cast("string")).otherwise(value)
    return sets.select(by.alias("by"), value.alias("value"), "n")


def apply_corrections(df: DataFrame, corrections: DataFrame, *, key: str, order: str, fields: tuple[str, ...], stamp: str = "corrected") -> tuple[DataFrame, DataFrame]:
    """(df with corrections applied, corrections with a flag ``applied``).

    A correction (key, field, original, corrected, ord) changes one row: of the rows of its key whose field
    has the original value, or is blank where that is blank, equal corrections take one each in order.
    corrected_fields lists what was changed in a row, comma-joined and sorted, empty for nothing; an unknown field is never applied.
    """
    same = lambda c: F.coalesce(squeeze(c.cast("string")), F.lit(""))
    long = df.select(key, order, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot([key, order], list(fields), "field", "__v")
    w = Window.partitionBy(key, "field", "__o").orderBy(order)
    wanted = corrections.select(key, "field", F.col("corrected").alias("__x"), F.col("ord").alias("__c"), same(F.col("original")).alias("__o"))
    wanted = wanted.withColumn("__n", F.row_number().over(Window.partitionBy(key, "field", "__o").orderBy("__c")))
    # Only rows of corrected keys and values are ranked.
    near = long.withColumn("__o", same(F.col("__v"))).join(wanted.select(key, "field", "__o").distinct(), [key, "field", "__o"], "left_semi")
    near = near.withColumn("__n", F.row_number().over(w))
    hit = near.join(wanted, [key, "field", "__o", "__n"]).select(F.col(order).alias("__ord"), "field", F.col("__x").alias("corrected"), "__c")
    wide = hit.groupBy("__ord").agg(*[F.max(F.when(F.col("field") == f, F.col("corrected"))).alias(f"__{f}") for f in fields], F.array_join(F.array_sort(F.collect_set("field")), ",").alias("__fields"))
    out = df.join(wide, F.col(order) == F.col("__ord"), "left")
    out = out.withColumns({f: F.coalesce(f"__{f}", f) for f in fields}).withColumn(f"{stamp}_fields", F.coalesce("__fields", F.lit("")))
    done = corrections.join(hit.select(F.col("__c").alias("ord"), F.lit(True).alias("applied")), "ord", "left").withColumn("applied", F.coalesce("applied", F.lit(False)))
    return out.drop("__ord", "__fields", *[f"__{f}" for f in fields]), done


def snippets(buckets: DataFrame, suggested: str = "suggested", score: str = "suggested_score", *, least: float = 0.5) -> DataFrame:
    """``buckets`` with an alias line for suggestions of at least the score, null below."""
    from corvina.functions.text import alias_line

    return buckets.withColumn("alias_snippet", F.when(F.col(score) >= least, alias_line(F.col("original"), F.col(suggested))))


def kinds(rules: Mapping[str, Column]) -> Column:
    """The name of the first rule that holds; null for none."""
    return F.coalesce(*[F.when(rule, name) for name, rule in rules.items()])
