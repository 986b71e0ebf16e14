"""Text, dates and figures by example."""

import contextlib
import io
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from corvina.functions import dates, numbers, text, unicode
from corvina.sources import web


def ask(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(rows.select("i", f(F.col("v")).alias("x")).collect())]


@pytest.mark.parametrize("raw, want", [(None, ""), ("", ""), ("hello\t\n world", "hello world"), ("A) Evitar", "Evitar"), ("12) Item", "Item"), ("II. Probabilidade", "Probabilidade"), ("iv) opção", "opção"), ("abcd) X", "abcd) X"), ("a​b", "ab")])
def test_norm_text(spark, raw, want):
    assert ask(spark, [raw], text.norm_text) == [want]


def test_accents(spark):
    assert ask(spark, ["Integração", "MAÇÃ", "ﬁm²", None], text.strip_accents) == ["Integracao", "MACA", "fim2", None]
    assert ask(spark, ["é"], lambda c: text.norm_text(c, compose=True)) == ["é"]


def test_fragments(spark):
    assert ask(spark, ["Probabilidade-", "-rência", "de de Ocor-", "raro", "", None], text.is_fragment) == [True, True, True, False, False, False]


def test_dates(spark):
    assert ask(spark, ["31/12/2025", "12/2025", "jun/25", "dez/2024", "texto qualquer", "", None], dates.parse_date) == ["2025-12-31", "2025-12", "2025-06", "2024-12", "texto qualquer", None, None]
    assert ask(spark, ["2025-3", "mar. 2025 (v2)", "15/03/2025", "03/2025", "a definir", None], dates.year_month) == ["2025-03"] * 4 + [None, None]
    assert ask(spark, ["2025-13", "x 2025-07", "1/12/2024", "12/2024"], dates.month_of) == [None, 7, 12, None]


def test_figures(spark):
    one = spark.range(1)
    assert one.select(numbers.ratio(F.lit(1), F.lit(0)), numbers.percent(F.lit(1), F.lit(3)), numbers.round_even(F.lit(2.675), 2), numbers.impact(F.lit(4), F.lit(0.25))).first()[:] == (0.0, 33.3, 2.67, 3.0)
    assert one.select(text.swapped_number(F.lit(1234567)), text.size_text(F.lit(2048)), text.size_text(F.lit(5)), text.letter_id(F.lit(26)), text.letter_id(F.lit(27)), text.slug(F.lit("A b/C"))).first()[:] == ("1.234.567", "2.0 KB", "5 B", "Z", "R27", "a-b-c")


def test_literals_and_flags(spark):
    assert ask(spark, ["Risco", "RISCO ", "outro", "", None], lambda c: text.is_literal(c, ("risco",))) == [True, True, False, False, False]
    assert ask(spark, ["true", "1", "0", None], text.is_true) == [True, True, False, False]
    assert ask(spark, ["nan", " ", "x", None], lambda c: text.is_blank(c, nan=True)) == [True, True, False, True]


def test_fetch_retries():
    calls, waits = [], []

    def get(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise OSError
        return 200, b"x"

    assert web.fetch("u", get=get, sleep=waits.append, delay=1) == b"x"
    assert len(calls) == 3 and waits == [1, 2, 1, 4, 1]
    assert web.fetch("u", get=lambda u, t: (503, b""), sleep=lambda s: None, retries=2) is None


def test_download(spark):
    def get(url, timeout):
        return (200, b"%PDF" + b"x" * 20_000) if "good" in url else (200, b"<html>")

    rows = spark.createDataFrame([("good",), ("good",), ("bad",), (None,)], "url string")
    assert {(r["url"], r["status"]) for r in web.download(rows, get=get, delay=0).collect()} == {("good", "ok"), ("bad", "not_the_type")}


def test_normal_forms_equal_the_library(spark):
    """Every assigned character of the lower planes, chance texts of marks, letters and syllables, a long run of marks, null and empty."""
    r = random.Random(3)
    known, marks = unicode._known(), list(unicode._classes())
    pool = known + marks + [chr(x) for x in range(0x41, 0x7B)] * 20 + [chr(unicode.L + i) for i in range(19)] * 3 + [chr(unicode.V + i) for i in range(21)] * 5 + [chr(unicode.TRAIL + i) for i in range(1, 28)] * 3 + [chr(0xAC00 + 28 * i) for i in range(300)] + ["\n", " ", "\U0001f600"] * 50
    few = list("aeiouAEIOUcnsyxz") + ["\u0300", "\u0301", "\u0302", "\u0303", "\u0308", "\u0327", "\u0323", "\u0304", "\u0328"] * 2
    texts = known + ["".join(r.choice(p) for _ in range(r.randrange(1, 13))) for p in (pool, few) for _ in range(4000)] + ["a" + "\u0323\u0301" * 500, "", "plain", "\x01e\u0301\x02"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", unicode.nfc(F.col("t")).alias("nfc"), text.strip_accents(F.col("t")).alias("plain")).collect()
    for x in rows:
        assert x["t"] is None and x["nfc"] is None and x["plain"] is None or x["nfc"] == unicodedata.normalize("NFC", x["t"]), ascii(x)
        assert x["t"] is None or x["plain"] == "".join(c for c in unicodedata.normalize("NFKD", x["t"]) if not unicodedata.combining(c)), ascii(x)


def test_normal_forms_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("x",)], "t string").select(text.norm_text(F.col("t")), text.strip_accents(F.col("t")))
    with contextlib.redirect_stdout(io.StringIO()) as shown:
        df.explain("formatted")
    assert "Project" in shown.getvalue() and "Eval" not in shown.getvalue()
