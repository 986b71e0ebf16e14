"""Ownership by content, membership of groups, and what members inherit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def own_by_content(df: DataFrame, content: Column, owner: str) -> DataFrame:
    """``df`` with content_md5, owner_key (the smallest key with that content) and is_owner; null content has neither.

    The owner comes from a keyed minimum and a join, so that no task sorts all copies of one content.
    """
    mine = df.withColumn("content_md5", F.md5(content))
    best = mine.where("content_md5 is not null").groupBy("content_md5").agg(F.min(owner).alias("owner_key")).withColumnRenamed("content_md5", "__m")
    out = mine.join(best, F.col("content_md5") == F.col("__m"), "left").drop("__m")
    return out.withColumn("is_owner", F.coalesce(F.col(owner) == F.col("owner_key"), F.lit(False)))


def expand_members(entities: DataFrame, groups: DataFrame, key: str, *inherited: str) -> DataFrame:
    """All entities and missing members of ``groups`` (head, member); null ``inherited`` columns take the head's value.

    inherited_from is the head whose values a member took, else null.
    """
    heads = entities.select(F.col(key).alias("head"), *[F.col(c).alias(f"__{c}") for c in inherited])
    members = groups.where("head != member").join(heads, "head").select(F.col("member").alias("__m"), "head", *[f"__{c}" for c in inherited])
    both = entities.join(members, F.col(key) == F.col("__m"), "full")
    takes = F.lit(False)
    for c in inherited:
        takes = takes | (F.col(c).isNull() & F.col(f"__{c}").isNotNull())
    return both.select(F.coalesce(key, "__m").alias(key), *[F.coalesce(c, f"__{c}").alias(c) for c in inherited], F.when(takes, F.col("head")).alias("inherited_from"))


def covered(entities: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """``entities`` with peer_rows, the rows of the other members of their group, 0 outside any group."""
    tagged = entities.join(groups.select(F.col("member").alias("__m"), "head"), F.col(key) == F.col("__m"), "left").drop("__m")
    sums = tagged.where("head is not null").groupBy("head").agg(F.sum(count).alias("__all")).withColumnRenamed("head", "__h")
    out = tagged.join(sums, F.col("head") == F.col("__h"), "left")
    return out.withColumn("peer_rows", F.coalesce(F.col("__all") - F.col(count), F.lit(0)).cast("long")).drop("__all", "__h")


def coverage_status(df: DataFrame, own: str, peers: str, source: Column, first_error: Column) -> Column:
    """ok, shared, no_source, the first error's kind, or no_rows: the first that holds."""
    return F.when(F.col(own) > 0, "ok").when(F.col(peers) > 0, "shared").when(source.isNull(), "no_source").otherwise(F.coalesce(first_error, F.lit("no_rows")))


def first_error(errors: DataFrame, key: str, kind: str, order: str) -> DataFrame:
    """(key, kind): the first error of each key by the order column."""
    return errors.groupBy(key).agg(F.min_by(kind, order).alias(kind))


def group_minimum(df: DataFrame, groups: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) where every member of a group that has any value gets the group's smallest, others their own."""
    tagged = df.join(groups.select(F.col("member").alias("__m"), "head"), F.col(key) == F.col("__m"), "left").drop("__m")
    low = tagged.where("head is not null").groupBy("head").agg(F.min(value).alias(value))
    members = groups.join(low, "head").select(F.col("member").alias(key), value)
    return tagged.where("head is null").select(key, value).unionByName(members).where(F.col(value).isNotNull())


def letter_ids(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` with item_id: the rows of a key lettered A to Z, then R27 and on, in the given order."""
    from corvina.functions.text import letter_id

    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).withColumn("item_id", letter_id(F.col("__n"))).drop("__n")
