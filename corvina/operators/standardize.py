"""Standardised deliveries and risks: terms, scores, reasons for review, confidence, and the reports on them.

The texts of all fields are gathered in one pass, matched once for every distinct normalised text and kept; rows
take their texts' results from there. What a match says about a text is recorded at the text's first row by the order
column, later rows only take the value: a reviewer sees every spelling once. No row is ever lost, whatever is null in it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvina.functions.text import norm_text, strip_accents
from corvina.functions.vocabularies import AXIS, IMPACT_SCALE, PROBABILITY_SCALE, PRODUCT, PRODUCT_AXIS, TREATMENTS, Vocabulary
from corvina.operators.canonical import match_fields, match_method
from corvina.sources.shared import kept, near

# What rows under review say, as reviewers' lists and the priorities of the queue know it.
UNKNOWN = "UNMATCHED"
OTHER = "Outros"
UNKNOWN_PRODUCT, DOUBTFUL_PRODUCT = "produto não reconhecido (melhor score: ", "fuzzy match baixo ("
AXIS_MOVED, AXIS_MOVED_TOO, MOVED_MARK = "eixo corrigido por cross-validation", "; eixo corrigido", "eixo corrigido"
UNKNOWN_LEVEL = {"probability": "probabilidade não reconhecida (score: ", "impact": "impacto não reconhecido (score: "}
DOUBTFUL_LEVEL = {"probability": "probabilidade fuzzy (", "impact": "impacto fuzzy ("}
UNKNOWN_PART, UNKNOWN_PART_END, SEVERAL_PARTS = "tratamento '", "' não reconhecido (score: ", "tratamento múltiplo/composto ('"

#: How long a description makes its row more than a fragment.
FRAGMENT = 10
#: What parts a text of several terms.
PARTS = r"\s*[;,/]\s*"


@dataclass(frozen=True)
class Field:
    """A column to standardise by a vocabulary; a composite one holds several terms."""

    col: str
    vocab: Vocabulary
    composite: bool = False


def field_maps(df: DataFrame, fields: Mapping[str, Field], order: str) -> DataFrame:
    """(field, original, raw, first, n, match, score, shown, method, is_alias, parts) for each distinct normalised text of every field.

    One scan of ``df``, one aggregation, one matching pass; the result is kept in the shared folder. first is the place of the text's
    first row, a null order last, and raw the text as it stands there, the smallest of equals; n counts rows. Null and
    blank texts are one, with score 0. A composite text has its parts' matches in parts, in order, and the worst part's score.
    """
    texts = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), F.coalesce(F.col(f.col).cast("string"), F.lit("")).alias("raw")) for name, f in fields.items()]))
    rows = df.select(F.col(order).alias("o"), texts.alias("x")).select("x.field", norm_text(F.col("x.raw")).alias("original"), F.struct(F.col("o").isNull().alias("late"), "o", F.col("x.raw").alias("raw")).alias("place"))
    found = rows.groupBy("field", "original").agg(F.min("place").alias("place"), F.count("*").alias("n"))
    composite = F.col("field").isin(*[n for n, f in fields.items() if f.composite])
    parts = F.filter(F.transform(F.split("original", PARTS), lambda p: F.trim(p)), lambda p: p != "")
    each = found.select("*", F.posexplode_outer(F.when(composite, parts).otherwise(F.array("place.raw"))).alias("i", "part"))
    each = match_fields(each, "part", {n: f.vocab for n, f in fields.items()})
    one = F.struct("i", "part", "match", "score", "shown", "method", "is_alias")
    maps = each.groupBy("field", "original").agg(F.first("place").alias("place"), F.first("n").alias("n"), F.array_sort(F.collect_list(one)).alias("parts"))
    maps = maps.withColumn("parts", F.filter("parts", lambda p: p["i"].isNotNull()))
    head = lambda c: F.get("parts", F.lit(0))[c]
    worst = F.when(F.col("original") == "", 0.0).otherwise(F.coalesce(F.array_min(F.transform("parts", lambda p: p["score"])), F.lit(1.0)))
    whole = strip_accents(F.lower("original"))
    alias = F.coalesce(*[F.when(F.col("field") == n, whole.isin(*[k.lower() for k in f.vocab.aliases])) for n, f in fields.items() if f.composite], head("is_alias"))
    maps = maps.select("field", "original", "place", "n", "parts", F.when(composite, F.lit(None).cast("string")).otherwise(head("match")).alias("match"), F.when(composite, worst).otherwise(head("score")).alias("score"), head("shown").alias("shown"), alias.alias("is_alias"))
    method = F.coalesce(*[F.when(F.col("field") == n, match_method(F.col("score"), F.col("is_alias"), f.vocab)) for n, f in fields.items()])
    return kept(maps.select("field", "original", F.col("place.raw").alias("raw"), F.struct("place.late", "place.o").alias("first"), "n", "match", "score", "shown", method.alias("method"), "is_alias", "parts"))


class _Rows:
    """``df`` under names that no column of its own can clash with, beside its fields' matches."""

    def __init__(self, df: DataFrame, order: str, fields: Mapping[str, Field], maps: Mapping[str, DataFrame], columns: Sequence[str]):
        self.names = df.columns
        out = df.toDF(*[f"c{i}" for i in range(len(self.names))])
        self.order = F.struct(self[order].isNull().alias("late"), self[order].alias("o"))
        out = out.withColumns({f"key_{n}": norm_text(self[f.col]) for n, f in fields.items()})
        for n, table in maps.items():
            mine = near(table).select(F.col("original").alias(f"own_{n}"), *[F.col(c).alias(f"{n}_{c}") for c in columns])
            out = out.join(mine, F.col(f"key_{n}") == F.col(f"own_{n}"), "left")
        self.df = out

    def __getitem__(self, name: str) -> Column:
        return F.col(f"c{self.names.index(name)}")

    def fresh(self, field: str) -> Column:
        """Whether a row is the first of its text; rows that tie for the first place all are."""
        return self.order.eqNullSafe(F.col(f"{field}_first"))

    def flag(self, name: str, otherwise: Column) -> Column:
        return F.coalesce(self[name], otherwise) if name in self.names else otherwise

    def done(self, values: Mapping[str, Column]) -> DataFrame:
        """The rows under their own names, ``values`` in the place of columns of their name or after all."""
        return self.df.select(*[values.get(n, self[n]).alias(n) for n in self.names], *[v.alias(n) for n, v in values.items() if n not in self.names])


def _flags(rows: _Rows) -> tuple[Column, Column, Column]:
    """needs_review, review_reason and confidence: false, null and high where the rows lack them."""
    return rows.flag("needs_review", F.lit(False)), rows.flag("review_reason", F.lit(None).cast("string")), rows.flag("confidence", F.lit("high"))


def _delivery_maps(df: DataFrame, order: str, product: str, axis: str) -> tuple[dict[str, Field], dict[str, DataFrame]]:
    fields = {"product": Field(product, PRODUCT), "axis": Field(axis, AXIS)}
    maps = field_maps(df, fields, order)
    value = lambda below: F.when(F.col("score") >= PRODUCT.low, F.col("match")).otherwise(below)
    return fields, {"product": maps.where("field = 'product'").withColumn("value", value(F.lit(PRODUCT.below))), "axis": maps.where("field = 'axis'").withColumn("value", value(F.col("raw")))}


def standardize_deliveries(df: DataFrame, *, order: str = "ord", product: str = "product", axis: str = "axis") -> DataFrame:
    """``df`` with <product>_value, _score, _method and the same of the axis, needs_review, review_reason and confidence.

    A product below 0.85 is reviewed with medium confidence, one below 0.70 is UNMATCHED with low confidence. An axis below 0.70 keeps
    its text. The axis that a known product belongs to overrides the row's, and is a reason for review of every row concerned.
    ``order`` tells rows apart: of rows with one text the first is reviewed, all of them where they tie, and rows without an order come
    last. Null and blank texts are unmatched; columns of these names in ``df`` are replaced; every row comes back once.
    """
    fields, maps = _delivery_maps(df, order, product, axis)
    rows = _Rows(df, order, fields, maps, ("first", "value", "score", "shown", "method"))
    review, reason, confidence = _flags(rows)
    score, shown, value = F.col("product_score"), F.col("product_shown"), F.col("product_value")
    fresh, doubtful, unknown = rows.fresh("product"), score < PRODUCT.high, score < PRODUCT.low
    why = F.when(fresh & unknown, F.concat(F.lit(UNKNOWN_PRODUCT), shown, F.lit(")"))).when(fresh & doubtful, F.concat(F.lit(DOUBTFUL_PRODUCT), shown, F.lit(")"))).otherwise(reason)
    own = F.element_at(F.create_map(*[F.lit(x) for pair in PRODUCT_AXIS.items() for x in pair]), value)
    rows.df = rows.df.withColumns({"why": why, "review": review | (fresh & doubtful), "own": own})
    moved = F.coalesce(F.col("own") != F.col("axis_value"), F.lit(False))
    change = F.concat(F.lit(": '"), "axis_value", F.lit("' → '"), "own", F.lit("'"))
    known = F.coalesce("why", F.lit(""))
    more = F.when((known == "") | known.contains(MOVED_MARK), F.col("why")).otherwise(F.concat(known, F.lit(AXIS_MOVED_TOO), change))
    return rows.done({
        "needs_review": F.col("review") | moved,
        "review_reason": F.when(moved & ~F.col("review"), F.concat(F.lit(AXIS_MOVED), change)).when(moved, more).otherwise(F.col("why")),
        "confidence": F.when(fresh & unknown, "low").when(fresh & doubtful, "medium").otherwise(confidence),
        f"{product}_value": value, f"{product}_score": F.round(score, 3), f"{product}_method": F.col("product_method"),
        f"{axis}_value": F.coalesce("own", "axis_value"), f"{axis}_score": F.round("axis_score", 3), f"{axis}_method": F.col("axis_method"),
    })


def _report(kind: str, field: DataFrame) -> DataFrame:
    return field.select(F.lit(kind).alias("type"), "original", F.col("value").alias("normalized"), "score", "n")


def _reports(maps: Mapping[str, DataFrame], names: Mapping[str, str]) -> DataFrame:
    out = None
    for name, field in maps.items():
        one = _report(names[name], field)
        out = one if out is None else out.unionByName(one)
    return out


def delivery_mappings(df: DataFrame, *, order: str = "ord", product: str = "product", axis: str = "axis") -> DataFrame:
    """(type, original, normalized, score, n): what became of every distinct product and axis, sorted by type and original."""
    return _reports(_delivery_maps(df, order, product, axis)[1], {"product": product, "axis": axis}).orderBy("type", "original")


FIELDS = {"probability": "probability", "impact": "impact", "treatment": "treatment"}


def _risk_maps(df: DataFrame, order: str, cols: Mapping[str, str]) -> tuple[dict[str, Field], dict[str, DataFrame]]:
    """What each of the three fields' texts become, with the reasons for review that a text's first row gets.

    A treatment has one part or several, each matched by itself; its score is the worst part's, 0 for a blank text.
    """
    vocabs = {"probability": PROBABILITY_SCALE, "impact": IMPACT_SCALE, "treatment": TREATMENTS}
    fields = {n: Field(cols[n], v, n == "treatment") for n, v in vocabs.items()}
    every, maps = field_maps(df, fields, order), {}
    none = F.array().cast("array<string>")
    for n in ("probability", "impact"):
        low, high = F.col("score") < vocabs[n].low, F.col("score") < vocabs[n].high
        reason = F.when(low, F.concat(F.lit(UNKNOWN_LEVEL[n]), "shown", F.lit(")"))).when(high, F.concat(F.lit(DOUBTFUL_LEVEL[n]), "shown", F.lit(")")))
        maps[n] = every.where(F.col("field") == n).withColumns({"value": F.when(low, F.col("raw")).otherwise(F.col("match")), "reasons": F.when(reason.isNotNull(), F.array(reason)).otherwise(none)})
    unknown = lambda p: p["score"] < TREATMENTS.low
    value = F.array_join(F.transform("parts", lambda p: F.when(unknown(p), p["part"]).otherwise(p["match"])), "; ")
    reasons = F.transform(F.filter("parts", unknown), lambda p: F.concat(F.lit(UNKNOWN_PART), p["part"], F.lit(UNKNOWN_PART_END), p["shown"], F.lit(")")))
    maps["treatment"] = every.where("field = 'treatment'").withColumns({"value": F.when(F.size("parts") > 0, value).otherwise(F.col("original")), "reasons": reasons})
    return fields, maps


def standardize_risks(df: DataFrame, *, order: str = "ord", fields: Mapping[str, str] = FIELDS) -> DataFrame:
    """``df`` with <field>_value, _score, _method of probability, impact and treatment, needs_review, review_reason and confidence.

    Below 0.70 a field keeps its text. The worst of the three scores sets the confidence: high from 0.85 on unless the row is under
    review, medium from 0.70, else low. A treatment of several parts is always reviewed. Reasons are appended to those the row has;
    a text's reasons stand at its first row, at all of them where they tie. Every row comes back once, nulls in any column included.
    """
    named, maps = _risk_maps(df, order, fields)
    rows = _Rows(df, order, named, maps, ("first", "value", "score", "method", "reasons"))
    review, reason, confidence = _flags(rows)
    none = F.array().cast("array<string>")
    several = F.col("treatment_value").contains("; ")
    reasons = [F.when(rows.fresh(n), F.col(f"{n}_reasons")).otherwise(none) for n in maps]
    reasons.append(F.when(several, F.array(F.concat(F.lit(SEVERAL_PARTS), F.substring("treatment_value", 1, 40), F.lit("')")))).otherwise(none))
    rows.df = rows.df.withColumns({"why": F.concat(*reasons), "worst": F.least(*[F.col(f"{n}_score") for n in maps]), "review": review | several})
    worst, some, text = F.col("worst"), F.size("why") > 0, F.array_join("why", "; ")
    values = {
        "needs_review": F.col("review") | (worst < 0.85) | some,
        "review_reason": F.when(~some, reason).when(F.coalesce(reason, F.lit("")) == "", text).otherwise(F.concat(reason, F.lit("; "), text)),
        "confidence": F.when(worst < 0.70, "low").when(worst < 0.85, "medium").when(~F.col("review"), "high").otherwise(confidence),
    }
    for n in maps:
        values |= {f"{fields[n]}_{x}": F.round(f"{n}_{x}", 3) if x == "score" else F.col(f"{n}_{x}") for x in ("value", "score", "method")}
    return rows.done(values)


def risk_mappings(df: DataFrame, *, order: str = "ord", fields: Mapping[str, str] = FIELDS) -> DataFrame:
    """(type, original, normalized, score, n): what became of every distinct text of the three fields, sorted by type and original."""
    return _reports(_risk_maps(df, order, fields)[1], {n: n for n in fields}).orderBy("type", "original")


def all_mappings(deliveries: DataFrame, risks: DataFrame, *, order: str = "ord") -> DataFrame:
    """(type, original, normalized, score, n) of all five fields of both tables in one list, sorted by type and original."""
    d, r = _delivery_maps(deliveries, order, "product", "axis")[1], _risk_maps(risks, order, FIELDS)[1]
    return _reports(d | r, {n: n for n in (*d, *r)}).orderBy("type", "original")


def match_stats(mappings: DataFrame) -> DataFrame:
    """(type, exact, fuzzy, unmatched): rows by how well their text matched: fully, from 0.70 on, or below."""
    rows = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    s = F.col("score")
    return mappings.groupBy("type").agg(rows(s == 1.0).alias("exact"), rows((s >= 0.70) & (s < 1.0)).alias("fuzzy"), rows(s < 0.70).alias("unmatched"))


def is_fragment(value: str = "product_value", service: str = "service") -> Column:
    """Whether a standardised delivery is a broken cell: no product of the catalogue and hardly a description."""
    return (F.col(value) == OTHER) & (F.length(F.trim(F.coalesce(service, F.lit("")))) < FRAGMENT)


def split_fragments(df: DataFrame, *, value: str = "product_value", service: str = "service") -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): standardised deliveries and those that are fragments; a null product is kept."""
    broken = F.coalesce(is_fragment(value, service), F.lit(False))
    return df.where(~broken), df.where(broken)


def fragments_by_owner(df: DataFrame, owner: str, *, value: str = "product_value", service: str = "service") -> DataFrame:
    """(owner, n): fragments of each owner that has any."""
    return split_fragments(df, value=value, service=service)[1].groupBy(owner).agg(F.count("*").alias("n"))
