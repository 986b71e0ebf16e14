"""Strict harmonisation: every cell a vocabulary term or empty, with a log of what changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvina.functions.text import is_blank, squeeze


def harmonize_cell(c: Column, allowed: Sequence[str], *, separator: str = "[;|]") -> Column:
    """(value, reason): a term stays, a repeated one is reduced (deduplicated), several terms (multiple_values) and others (column_bleed) are emptied.

    Blank text and the text nan give an empty value without a reason.
    """
    parts = F.array_distinct(F.filter(F.transform(F.split(c, separator), squeeze), lambda p: p != ""))
    known = F.forall(parts, lambda p: p.isin(*allowed))
    pack = lambda v, r: F.struct(v.alias("value"), r.cast("string").alias("reason"))
    none, empty = F.lit(None), F.lit("")
    cell = squeeze(c)
    return (
        F.when(is_blank(c, nan=True), pack(empty, none))
        .when(cell.isin(*allowed), pack(cell, none))
        .when((F.size(parts) == 1) & known, pack(F.get(parts, F.lit(0)), F.lit("deduplicated")))
        .when((F.size(parts) > 1) & known, pack(empty, F.lit("multiple_values")))
        .otherwise(pack(empty, F.lit("column_bleed")))
    )


def harmonize(df: DataFrame, vocabularies: Mapping[str, Sequence[str]], *, order: str, owner: str) -> tuple[DataFrame, DataFrame]:
    """(df with strict columns, change log), the log with row, owner, field, before, after, reason.

    needs_review is set where a value was emptied, and review_reason gets harmonized(field:reason,…) appended.
    """
    cells = df.withColumns({f"__{c}": harmonize_cell(F.col(c), allowed) for c, allowed in vocabularies.items()})
    notes = F.array_compact(F.array(*[F.when(F.col(f"__{c}.reason").isNotNull(), F.concat(F.lit(f"{c}:"), F.col(f"__{c}.reason"))) for c in vocabularies]))
    emptied = F.exists(notes, lambda n: ~n.endswith(":deduplicated"))
    log_fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("before"), F.col(f"__{c}.value").alias("after"), F.col(f"__{c}.reason").alias("reason")) for c in vocabularies])
    log = cells.select(F.col(order).alias("row"), F.col(owner).alias("owner"), F.explode(log_fields).alias("x")).select("row", "owner", "x.*").where(F.col("reason").isNotNull() & ~F.col("before").eqNullSafe(F.col("after")))
    old = F.col("review_reason") if "review_reason" in df.columns else F.lit(None).cast("string")
    flag = F.col("needs_review") if "needs_review" in df.columns else F.lit(False)
    note = F.when(emptied, F.concat(F.lit("harmonized("), F.array_join(notes, ","), F.lit(")")))
    out = cells.withColumn("needs_review", F.coalesce(flag, F.lit(False)) | emptied).withColumn("review_reason", F.nullif(F.concat_ws("; ", old, note), F.lit("")))
    return out.withColumns({c: F.col(f"__{c}.value") for c in vocabularies}).drop(*[f"__{c}" for c in vocabularies]), log
