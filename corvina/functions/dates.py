"""Dates in free text: three readings of different strictness."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvina.functions.text import let, norm_text, squeeze

#: Three-letter month names and their numbers; another language's can be given.
MONTHS = {"jan": "01", "fev": "02", "mar": "03", "abr": "04", "mai": "05", "jun": "06", "jul": "07", "ago": "08", "set": "09", "out": "10", "nov": "11", "dez": "12"}


def _month(name: Column, months: Mapping[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in months.items():
        out = F.when(name == k, v).otherwise(out)
    return out


def _year(c: Column) -> Column:
    return F.when(F.length(c) == 2, F.concat(F.lit("20"), c)).otherwise(c)


def _found(c: Column, pattern: str, *groups: int) -> list[Column]:
    return [F.when(c.rlike(pattern), F.regexp_extract(c, pattern, g)) for g in groups]


def parse_date(c: Column, months: Mapping[str, str] = MONTHS) -> Column:
    """ISO day or month from dd/mm/yyyy, mm/yyyy, ISO or mon/yy anywhere it is first found; else the normalised text.

    No range is checked. Null and empty give null.
    """

    def read(s: Column) -> Column:
        d, m, y = _found(s, r"(\d{2})/(\d{2})/(\d{4})", 1, 2, 3)
        m2, y2 = _found(s, r"(\d{2})/(\d{4})", 1, 2)
        iso = _found(s, r"\d{4}-\d{2}-\d{2}", 0)[0]
        name, short = _found(F.lower(s), r"^([a-záéíóú]{3})[./\-](\d{2,4})", 1, 2)
        named = let(_month(name, months), lambda n: F.when(n.isNotNull(), F.concat_ws("-", _year(short), n)))
        return F.coalesce(F.concat(y, F.lit("-"), m, F.lit("-"), d), F.concat(y2, F.lit("-"), m2), iso, named, s)

    return F.when(F.coalesce(c, F.lit("")) != "", let(norm_text(c), read))


def year_month(c: Column, months: Mapping[str, str] = MONTHS) -> Column:
    """yyyy-mm from an ISO start, a month name with a year, d/m/yyyy or m/yyyy; else null. No range is checked."""

    def read(s: Column) -> Column:
        y, m = _found(s, r"^(\d{4})-(\d{1,2})", 1, 2)
        name, y1 = _found(s, r"(" + "|".join(months) + r")[a-zç]*[./\-\s]*(?:de\s+)?(\d{4}|\d{2})\b", 1, 2)
        m2, y2 = _found(s, r"(\d{1,2})/(\d{1,2})/(\d{4})", 2, 3)
        m3, y3 = _found(s, r"(\d{1,2})/(\d{4})", 1, 2)
        join = lambda y, m: F.concat(y, F.lit("-"), F.lpad(m, 2, "0"))
        return F.coalesce(join(y, m), join(_year(y1), _month(name, months)), join(y2, m2), join(y3, m3))

    return let(F.lower(squeeze(F.coalesce(c, F.lit("")))), read)


def month_of(c: Column) -> Column:
    """The month's number from an ISO month anywhere or a d/m/yyyy start; null unless 1 to 12."""
    iso = r"\d{4}-(\d{2})"
    got = let(squeeze(F.coalesce(c, F.lit(""))), lambda s: F.coalesce(_found(s, iso, 1)[0], _found(s, r"^\d{1,2}/(\d{1,2})/\d{4}", 1)[0]).try_cast("int"))
    return let(got, lambda n: F.when(n.between(1, 12), n))
