"""Matching by bounded search, rows that keep their place, and decomposed, ligated and full-width spellings."""

import difflib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from corvina.functions.vocabularies import AXIS, IMPACT_SCALE, PRODUCT, TREATMENTS
from corvina.operators import canonical, standardize
from corvina.operators.canonical import TermIndex, _plain


def plain_best(text, terms):
    best, score = None, 0.0
    for i, t in enumerate(terms):
        r = difflib.SequenceMatcher(None, text, t).ratio()
        if r > score:
            best, score = i, r
    return best, score


def garbled(r, t):
    t = list(t)
    for _ in range(r.randrange(9)):
        i = r.randrange(len(t) + 1)
        t[i : i + r.randrange(2)] = r.choice(["", "a", "e", " ", "xyz"])
    return "".join(t) or "x"


def test_bounded_search_equals_comparing_all():
    """Hundreds of terms, ties, empty terms, letters that no term has; few terms are ever compared."""
    r = random.Random(1)
    own = tuple(map(_plain, PRODUCT.terms))
    words = " ".join(own).split()
    many = tuple(dict.fromkeys(" ".join(r.choice(words) for _ in range(r.randrange(2, 7))) for _ in range(400)))
    for terms in (own, many, ("", "a", "aa", "b", "ab", "ba"), ("abc", "cab", "abc")):
        index = TermIndex(terms)
        texts = [garbled(r, r.choice(terms)) for _ in range(60)] + [" ".join(r.choice(words) for _ in range(4)) for _ in range(20)] + ["zzz", "§", "ab" * 150]
        for t in texts:
            assert index.best(t) == plain_best(t, terms), t
        assert len(terms) < 50 or index.compared < len(texts) * len(terms) / 20


def test_a_hundred_thousand_misses_meet_few_terms(spark):
    """Distinct misses against a thousand terms: as many comparisons as texts, about, and a sample of them by comparing all."""
    r = random.Random(2)
    words = " ".join(map(_plain, PRODUCT.terms)).split()
    terms = tuple(dict.fromkeys(" ".join(r.choice(words) for _ in range(r.randrange(3, 7))) for _ in range(1000)))
    index = TermIndex(terms)
    texts = list(dict.fromkeys(garbled(r, r.choice(terms)) + str(i) for i in range(3000)))
    got = [index.best(t) for t in texts]
    assert index.compared < 4 * len(texts)
    for t, g in list(zip(texts, got))[::100]:
        assert g == plain_best(t, terms)
    rows = spark.range(100_000).select(F.concat(F.get(F.array(*map(F.lit, terms[:50])), (F.col("id") % 50).cast("int")), F.lit(" "), F.col("id").cast("string")).alias("raw"))
    vocab = canonical.Vocabulary("many", terms)
    out = canonical.match_values(rows, "raw", vocab)
    assert out.count() == 100_000
    some = out.where("pmod(xxhash64(raw), 4000) = 0").collect()
    assert some
    for x in some:
        best, score = plain_best(_plain(x["raw"]), terms)
        assert (x["match"], x["score"]) == (terms[best], score)


@pytest.mark.parametrize("text, want, vocab", [("Adequação à LGPD", ("Adequação à LGPD", 1.0, "exact"), PRODUCT), ("Integração ao Login Unico", ("Integração ao Login Único", 1.0, "exact"), PRODUCT), ("médio", ("médio", 1.0, "exact"), IMPACT_SCALE), ("Governança de Dados", None, AXIS)])
def test_spellings_of_one_text(spark, text, want, vocab):
    """Composed, decomposed, with format characters and full-width letters: each as the composed text."""
    wide = "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in text)
    forms = [text, unicodedata.normalize("NFD", text), "​" + text + "­", wide]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(forms)], "i int, raw string")
    got = {r["raw"]: (r["match"], r["score"], r["method"]) for r in canonical.match_values(rows, "raw", vocab).collect()}
    assert got[forms[0]] == got[forms[1]] == got[forms[2]] and (want is None or got[forms[0]] == want)
    assert want is None or got[wide][0] == want[0] and got[wide][1] >= 0.95


def test_ligatures_match(spark):
    rows = spark.createDataFrame([("Unificação de Canais Digitais".replace("fi", "ﬁ"),)], "raw string")
    assert canonical.match_values(rows, "raw", AXIS).first()["score"] == 1.0


def test_no_delivery_is_lost(spark):
    """Null, repeated and missing orders; nulls in every column; columns whose names could clash."""
    rows = [(1, "xx yy", "zz", 1), (None, "qq ww", None, 2), (None, "qq ww", "zz", 3), (2, None, None, 4), (2, "", " ", 5), (1, "xx yy", "zz", 6), (None, None, None, None)]
    df = spark.createDataFrame(rows, "ord int, product string, axis string, id int").withColumns({c: F.lit(1) for c in ("own", "why", "key_product", "product_first", "c0", "field")})
    got = standardize.standardize_deliveries(df).collect()
    assert sorted(str(r["id"]) for r in got) == sorted(str(r[3]) for r in rows)
    assert len(set(got[0].__fields__)) == len(got[0].__fields__)
    by = {r["id"]: r for r in got}
    # Rows that tie for a text's first place are all marked, those without an order come after the others.
    assert by[1]["review_reason"] == by[6]["review_reason"] and by[1]["review_reason"].startswith(standardize.UNKNOWN_PRODUCT)
    assert by[2]["review_reason"] == by[3]["review_reason"] is not None
    assert standardize.delivery_mappings(df).agg(F.sum("n")).first()[0] == 2 * len(rows)
    assert standardize.standardize_deliveries(df.limit(0)).isEmpty()


def test_no_risk_is_lost(spark):
    rows = [(1, "alta", "alto", "mitigar", 1), (1, "alta", None, "nada; mitigar", 2), (None, None, "xx", "nada; mitigar", 3), (None, "foo", "", None, 4), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "ord int, probability string, impact string, treatment string, id int").withColumn("worst", F.lit(0)).withColumn("n", F.lit(0))
    got = {r["id"]: r for r in standardize.standardize_risks(df).collect()}
    assert len(got) == len(rows) and got[3]["treatment_value"] == "nada; mitigar"
    assert "'nada' não reconhecido" in got[2]["review_reason"] and "'nada' não" not in got[3]["review_reason"]
    assert standardize.risk_mappings(df).agg(F.sum("n")).first()[0] == 3 * len(rows)


def test_all_mappings(spark):
    d = spark.createDataFrame([(1, "Outros", "x")], "ord int, product string, axis string")
    r = spark.createDataFrame([(1, "raro", "alto", "mitigar")], "ord int, probability string, impact string, treatment string")
    assert [x["type"] for x in standardize.all_mappings(d, r).collect()] == ["axis", "impact", "probability", "product", "treatment"]


def test_terms_tables_are_one_pass(spark):
    """The result reads its rows once: matches come from the kept table."""
    import contextlib
    import io

    spark.range(20).selectExpr("id AS ord", "'mitigar' AS treatment", "'raro' AS probability", "'alto' AS impact").write.mode("overwrite").saveAsTable("one_pass_rows")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as shown:
            standardize.standardize_risks(spark.table("one_pass_rows")).explain()
        assert shown.getvalue().count("FileScan") == 1
    finally:
        spark.sql("DROP TABLE one_pass_rows")


def test_composite_alias_as_a_whole(spark):
    df = spark.createDataFrame([(1, "raro", "alto", next(iter(TREATMENTS.aliases)))], "ord int, probability string, impact string, treatment string")
    assert standardize.standardize_risks(df).first()["treatment_value"]
