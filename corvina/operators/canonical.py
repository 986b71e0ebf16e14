"""Canonicalisation of free text against closed vocabularies."""

from __future__ import annotations

import difflib
import unicodedata
from collections import Counter
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvina.functions.text import norm_text, strip_accents
from corvina.functions.vocabularies import Vocabulary

#: Rows of lookup tables that may be broadcast; larger vocabularies are joined by exchange.
BROADCAST_FORMS = 200_000


def _plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))


class TermIndex:
    """Finds the first term with the largest Ratcliff-Obershelp ratio to a text, comparing only terms that can still win.

    A ratio is twice the matched letters by the letters of both. They are no more than the letters that both have, and no more
    than their longest common subsequence; both bounds are exact, so no winner is missed. The term that shares the
    most letter pairs with the text is compared first, since its ratio is hard to beat.
    """

    def __init__(self, terms: tuple[str, ...]):
        self.terms = terms
        self.place = {c: i for i, c in enumerate(sorted({c for t in terms for c in t}))}
        self.letters = np.zeros((len(terms), len(self.place)), np.int32)
        self.sizes = np.array([len(t) for t in terms], np.int64)
        pairs: dict[str, Counter] = {}
        for i, t in enumerate(terms):
            for c, n in Counter(t).items():
                self.letters[i, self.place[c]] = n
            for pair, n in Counter(a + b for a, b in zip(t, t[1:])).items():
                pairs.setdefault(pair, Counter())[i] = n
        self.pairs = {p: (np.array(list(at)), np.array(list(at.values()))) for p, at in pairs.items()}
        self.matchers: dict[int, difflib.SequenceMatcher] = {}
        self.masks: dict[int, dict[str, int]] = {}
        self.compared = 0

    def ratio(self, text: str, i: int) -> float:
        """The ratio depends on the order of its arguments: the text first."""
        if i not in self.matchers:
            self.matchers[i] = difflib.SequenceMatcher(None, "", self.terms[i])
        self.compared += 1
        self.matchers[i].set_seq1(text)
        return self.matchers[i].ratio()

    def common(self, text: str, i: int) -> int:
        """Length of the longest common subsequence, by one addition of wide numbers a letter."""
        term = self.terms[i]
        if i not in self.masks:
            own: dict[str, int] = {}
            for k, c in enumerate(term):
                own[c] = own.get(c, 0) | 1 << k
            self.masks[i] = own
        full, own = (1 << len(term)) - 1, self.masks[i]
        open_ = full
        for c in text:
            if hit := open_ & own.get(c, 0):
                open_ = (open_ + hit | open_ - hit) & full
        return len(term) - open_.bit_count()

    def best(self, text: str) -> tuple[int | None, float]:
        """(place, ratio) of the best term, the first of equals; (None, 0.0) where no term shares a letter."""
        have = np.zeros(len(self.place), np.int32)
        for c, n in Counter(text).items():
            if c in self.place:
                have[self.place[c]] = n
        both = self.sizes + len(text)
        bounds = 2.0 * np.minimum(self.letters, have).sum(axis=1) / np.maximum(both, 1)
        near = np.zeros(len(self.terms), np.int64)
        for pair, n in Counter(a + b for a, b in zip(text, text[1:])).items():
            if pair in self.pairs:
                at, m = self.pairs[pair]
                near[at] += np.minimum(m, n)
        best, score = None, 0.0
        first = int((2.0 * near / np.maximum(both, 1)).argmax()) if len(near) and near.any() else None
        if first is not None:
            best, score = first, self.ratio(text, first)
        for i in np.argsort(-bounds, kind="stable").tolist():
            if bounds[i] < score or bounds[i] <= 0:
                break
            if i == first:
                continue
            could = 2.0 * self.common(text, i) / (len(text) + len(self.terms[i]))
            if could < score or could == score and best is not None and i > best:
                continue
            r = self.ratio(text, i)
            if r > score or r == score > 0 and i < best:
                best, score = i, r
        return (best, score) if score > 0 else (None, 0.0)


def best_ratio(name: Column, text: Column, terms: Mapping[str, tuple[str, ...]]) -> Column:
    """(pos, score, shown): the best term of the vocabulary ``name`` for a folded text, and its score with two decimals.

    pos is null at score 0; a null text, which needs no comparison, gives nulls.
    """
    folded = {k: tuple(map(_plain, v)) for k, v in terms.items()}

    @F.pandas_udf("pos int, score double, shown string")
    def f(names: pd.Series, values: pd.Series) -> pd.DataFrame:
        indexes: dict[str, TermIndex] = {}
        found: dict[tuple[str, str], tuple[int | None, float]] = {}
        out = []
        for k, v in zip(names, values):
            if v is None:
                out.append((None, None, None))
                continue
            if (k, v) not in found:
                if k not in indexes:
                    indexes[k] = TermIndex(folded[k])
                found[k, v] = indexes[k].best(v)
            pos, score = found[k, v]
            # The decimals are those of the binary value.
            out.append((pos, score, f"{score:.2f}"))
        return pd.DataFrame(out, columns=["pos", "score", "shown"]).astype({"pos": "Int32", "score": "float64", "shown": object})

    return f(name, text)


def lookup_rows(vocabs: Mapping[str, Vocabulary]) -> dict[int, list[tuple]]:
    """For texts in lower case (0) and folded (1): (name, key, target, a_score, a_rank, term, pos) of every alias and term.

    Of aliases with one key the first counts, of terms too; ranks go by an alias's place, its literal form first.
    """
    out: dict[int, dict[tuple[str, str], list]] = {0: {}, 1: {}}
    for name, vocab in vocabs.items():
        for i, (k, v) in enumerate(vocab.aliases.items()):
            for form, key, score in ((0, k.lower(), vocab.literal), (1, _plain(k), vocab.folded)):
                row = out[form].setdefault((name, key), [None] * 5)
                if row[0] is None:
                    row[:3] = v, float(score), 2 * i + form
        for i, t in enumerate(vocab.terms):
            for form, key in ((0, t.lower()), (1, _plain(t))):
                row = out[form].setdefault((name, key), [None] * 5)
                if row[3] is None:
                    row[3:] = t, i
    return {form: [(*k, *row) for k, row in rows.items()] for form, rows in out.items()}


def match_method(score: Column, is_alias: Column, vocab: Vocabulary) -> Column:
    """exact, alias, fuzzy_high, fuzzy_low or unmatched, in this order of precedence."""
    return F.when(score <= 0, "unmatched").when(score >= 0.999, "exact").when(is_alias, "alias").when(score >= vocab.high, "fuzzy_high").when(score >= vocab.low, "fuzzy_low").otherwise("unmatched")


def match_fields(texts: DataFrame, col: str, vocabs: Mapping[str, Vocabulary], *, name: str = "field", fuzzy: bool = True) -> DataFrame:
    """``texts`` with match, score, shown, method and is_alias of the text in ``col`` by the vocabulary that ``name`` names.

    One pass for all vocabularies: two joins with their aliases and terms, by the text in lower case and folded, then a
    search among the terms for texts without a hit. An alias goes before a term, the smaller place first. Null and blank
    texts are unmatched with score 0. Give distinct texts: the work grows with the rows.
    """
    spark = texts.sparkSession
    names = texts.columns
    mine = texts.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: F.col(f"c{i}") for i, n in enumerate(names)}
    mine = mine.withColumn("low", F.lower(norm_text(at[col]))).withColumn("fold", strip_accents(F.col("low")))
    for form, rows in lookup_rows(vocabs).items():
        known = spark.createDataFrame(rows, "name string, key string, target string, a_score double, a_rank int, term string, pos int").select(F.struct("name", "key").alias(f"k{form}"), F.struct("target", "a_score", "a_rank").alias(f"a{form}"), F.struct("term", "pos").alias(f"t{form}"))
        known = F.broadcast(known) if len(rows) <= BROADCAST_FORMS else known
        mine = mine.join(known, F.struct(at[name].alias("name"), F.col("fold" if form else "low").alias("key")) == F.col(f"k{form}"), "left")
    last = F.lit(2**31 - 1)
    first = lambda x, y, rank: F.when(F.coalesce(y[rank], last) < F.coalesce(x[rank], last), y).otherwise(x)
    mine = mine.withColumn("a", first(F.col("a0"), F.col("a1"), "a_rank")).withColumn("t", first(F.col("t0"), F.col("t1"), "pos"))
    open_ = (F.col("low") != "") & F.col("a.target").isNull() & F.col("t.term").isNull()
    terms = {k: v.terms for k, v in vocabs.items()}
    if fuzzy:
        mine = mine.withColumn("r", best_ratio(at[name], F.when(open_, F.col("fold")), terms))
    else:
        mine = mine.withColumn("r", F.lit(None).cast("struct<pos:int,score:double,shown:string>"))
    named = lambda of: F.coalesce(*[F.when(at[name] == k, of(v)) for k, v in vocabs.items()])
    is_alias, blank = F.col("a.target").isNotNull(), F.col("low") == ""
    score = F.when(blank, 0.0).otherwise(F.coalesce("a.a_score", F.when(F.col("t.term").isNotNull(), 1.0), "r.score", F.lit(0.0)))
    match = F.when(blank, "").otherwise(F.coalesce("a.target", "t.term", named(lambda v: F.get(F.array(*map(F.lit, v.terms)), F.col("r.pos"))), F.lit("")))
    done = mine.select(*[c.alias(n) for n, c in at.items()], match.alias("match"), score.alias("score"), F.col("r.shown").alias("r_shown"), (is_alias & ~blank).alias("is_alias"))
    return done.select(*names, "match", "score", F.coalesce("r_shown", F.format_string("%.2f", "score")).alias("shown"), F.coalesce(*[F.when(F.col(name) == k, match_method(F.col("score"), F.col("is_alias"), v)) for k, v in vocabs.items()]).alias("method"), "is_alias")


def match_values(values: DataFrame, col: str, vocab: Vocabulary, *, fuzzy: bool = True) -> DataFrame:
    """(col, match, score, method) for each distinct text of ``col``, its cost independent of the number of rows; see ``match_fields``."""
    texts = values.select(F.col(col).alias("raw")).distinct().withColumn("field", F.lit(vocab.name))
    return match_fields(texts, "raw", {vocab.name: vocab}, fuzzy=fuzzy).select(F.col("raw").alias(col), "match", "score", "method")


def canonicalize(df: DataFrame, col: str, vocab: Vocabulary, *, fuzzy: bool = True, prefix: str | None = None) -> DataFrame:
    """``df`` with <prefix>_value, _score, _method and _doubt for the text in ``col``.

    Sure matches take the term; doubtful ones too, marked in _doubt; others keep the raw text or take the
    vocabulary's stand-in, marked as well. Scores are rounded to three places.
    """
    p = prefix or vocab.name
    found = match_values(df, col, vocab, fuzzy=fuzzy).withColumnRenamed(col, "__raw")
    below = F.col("__raw") if vocab.below is None else F.lit(vocab.below)
    found = found.select("__raw", F.when(F.col("score") >= vocab.low, F.col("match")).otherwise(below).alias(f"{p}_value"), F.round("score", 3).alias(f"{p}_score"), F.col("method").alias(f"{p}_method"), (F.col("score") < vocab.high).alias(f"{p}_doubt"))
    return df.join(found, F.col(col).eqNullSafe(F.col("__raw")), "left").drop("__raw")


def first_of(df: DataFrame, key: Column, order: str, name: str = "is_first") -> DataFrame:
    """``df`` with a flag for the first row of each key by the order column, nulls first; rows that tie for it are all marked.

    A keyed minimum finds the places, so a frequent key is never sorted in one task.
    """
    place = F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("order"))
    mine = df.withColumn("__k", key).withColumn("__o", place)
    least = mine.groupBy(F.col("__k").alias("__key")).agg(F.min("__o").alias("__least"))
    out = mine.join(least, F.col("__k").eqNullSafe(F.col("__key")))
    return out.select(*[F.col(c) for c in df.columns], F.col("__o").eqNullSafe(F.col("__least")).alias(name))


def override(df: DataFrame, key: str, value: str, table: DataFrame) -> DataFrame:
    """``df`` with ``value`` set to what ``table`` (key, expected) expects for the key, and a flag ``overridden``.

    Keys that the table lacks keep their value.
    """
    t = table.toDF("__k", "__e")
    out = df.join(t, F.col(key) == F.col("__k"), "left")
    differs = F.col("__e").isNotNull() & ~F.col(value).eqNullSafe(F.col("__e"))
    return out.withColumn("overridden", differs).withColumn(value, F.coalesce("__e", value)).drop("__k", "__e")


def composite(df: DataFrame, col: str, order: str, vocab: Vocabulary, *, separator: str = r"\s*[;,/]\s*", fuzzy: bool = True) -> DataFrame:
    """``df`` with <name>_value, _score, _parts: a text of several parts, each matched, joined in order by "; ".

    The score is that of the worst part; a part below the vocabulary's low cut stays as it is. A text that is
    an alias as a whole isn't parted. Blank texts give an empty value, score 0 and no parts.
    """
    n = vocab.name
    whole = match_values(df, col, vocab, fuzzy=False).where("score > 0").select(F.col(col).alias("__w"), F.col("match").alias("__m"), F.col("score").alias("__s"))
    texts = df.select(F.col(col).alias("raw")).distinct()
    parts = texts.select("raw", F.posexplode(F.split(norm_text(F.col("raw")), separator)).alias("i", "part")).where("part != ''")
    got = match_values(parts, "part", vocab, fuzzy=fuzzy).withColumnRenamed("part", "__p")
    each = parts.join(got, F.col("part") == F.col("__p")).withColumn("v", F.when(F.col("score") >= vocab.low, F.col("match")).otherwise(F.col("part")))
    joined = each.groupBy("raw").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]), "; ").alias("v"), F.min("score").alias("s"), F.count("*").alias("c"))
    one = texts.join(joined.withColumnRenamed("raw", "__r"), F.col("raw") == F.col("__r"), "left").join(whole, F.col("raw") == F.col("__w"), "left")
    one = one.select(F.col("raw").alias("__raw"), F.coalesce("__m", "v", F.lit("")).alias(f"{n}_value"), F.round(F.coalesce("__s", "s", F.lit(0.0)), 3).alias(f"{n}_score"), F.when(F.col("__m").isNotNull(), F.size(F.split("__m", ";"))).otherwise(F.coalesce("c", F.lit(0))).cast("int").alias(f"{n}_parts"))
    return df.join(one, F.col(col).eqNullSafe(F.col("__raw")), "left").drop("__raw")
