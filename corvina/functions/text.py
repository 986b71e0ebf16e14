"""Text normalisation as Column builders; everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvina.functions.unicode import let, nfc, strip_accents

ENUMERATOR = r"^[A-Za-z0-9]{1,3}(?U:\s)*[).\-](?U:\s)+"
BLANKS = r"(?U)\s+"
#: Accented Latin letters and their plain forms, for texts known to hold no others.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def plain_latin(c: Column) -> Column:
    """Accented Latin letters without their accents, in the JVM."""
    return F.translate(c, ACCENTED, PLAIN)


def squeeze(c: Column) -> Column:
    """Runs of any Unicode white space as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, BLANKS, " "), r"^ | $", "")


def norm_text(c: Column, *, compose: bool = True) -> Column:
    """Without format characters, composed unless told not to, white space squeezed, one leading enumerator off; null is empty."""
    c = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\p{Cf}", "")
    return F.regexp_replace(squeeze(nfc(c) if compose else c), ENUMERATOR, "")


def fold_key(c: Column) -> Column:
    """Normalised, lower case, without accents or compatibility forms; composing first would change nothing here."""
    return strip_accents(F.lower(norm_text(c, compose=False)))


def header_key(c: Column) -> Column:
    """Folded header text with words broken by a hyphen joined again."""
    return strip_accents(F.replace(F.lower(norm_text(c, compose=False)), F.lit("- "), F.lit("")))


def plain_lower(c: Column) -> Column:
    """White space squeezed and lower case; format characters and enumerators stay."""
    return F.lower(squeeze(F.coalesce(c.cast("string"), F.lit(""))))


def is_blank(c: Column, *, nan: bool = False) -> Column:
    """Null or white space only; with ``nan`` the text nan as well."""
    s = squeeze(F.coalesce(c.cast("string"), F.lit("")))
    return (s == "") | (F.lower(s) == "nan") if nan else s == ""


def is_literal(c: Column, literals: Sequence[str], *, key=fold_key) -> Column:
    """Whether the folded text is one of the literals; blank is not."""
    return ~is_blank(c) & key(c).isin(*literals)


def is_fragment(c: Column) -> Column:
    """A word cut by a hyphen at either end, or a short word put twice in a row; null is not."""
    return let(squeeze(F.coalesce(c, F.lit(""))), lambda s: s.rlike(r"(?U)\S-$") | s.rlike(r"^-[a-záéíóúâêôãõç]") | F.lower(s).rlike(r"(?U)\b(\w{1,3})\s+\1\b"))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """Whether the text holds any of the words."""
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def hits(c: Column, words: Sequence[str]) -> Column:
    """How many of the words the text holds."""
    return sum((c.contains(w).cast("int") for w in words), F.lit(0))


def is_true(c: Column) -> Column:
    """A flag kept as text: true or 1."""
    return F.lower(squeeze(F.coalesce(c.cast("string"), F.lit("")))).isin("true", "1")


def clip(c: Column, n: int, *, mark: str = "") -> Column:
    """The first n characters, with a mark where something is cut."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(mark))).otherwise(c)


def labelled(**parts: Column) -> Column:
    """``P:x | I:y``: the parts with their labels; a null part is written None."""
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}:"), F.coalesce(v.cast("string"), F.lit("None"))) for k, v in parts.items()])


def slug(c: Column) -> Column:
    """Lower case with spaces and slashes as hyphens."""
    return F.regexp_replace(F.lower(c), "[ /]", "-")


def size_text(c: Column) -> Column:
    """A number of bytes as B, KB or MB."""
    return F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B"))).when(c < 1024**2, F.concat(F.format_string("%.1f", c / 1024), F.lit(" KB"))).otherwise(F.concat(F.format_string("%.1f", c / 1024**2), F.lit(" MB")))


def swapped_number(c: Column, digits: int = 0) -> Column:
    """A number with points between thousands and a decimal comma."""
    return F.translate(F.format_number(c, digits), ",.", ".,")


def letter_id(n: Column) -> Column:
    """A to Z for positions 1 to 26, then R27 and on."""
    return F.when(n <= 26, F.chr(64 + n)).otherwise(F.concat(F.lit("R"), n.cast("string")))


def link_kind(anchor: Column, href: Column, kinds: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The first kind whose words stand in the link's text, else in its file name; null for none."""
    file = plain_latin(F.lower(F.regexp_extract(href, "[^/]*$", 0)))
    out = [F.when(contains_any(key, words), kind) for key in (fold_key(anchor), file) for kind, words in kinds]
    return F.coalesce(*out)


def header_codes(c: Column, prefix: str) -> Column:
    """Upper-case codes of a header ``prefix A / B (new):`` in their order; empty for none."""
    s = F.regexp_replace(norm_text(c), f"(?iU){prefix}\\s*", "")
    s = F.regexp_replace(squeeze(s), r"(?U)[\s:–\-]+$", "")
    parts = F.transform(F.split(s, "/"), lambda x: squeeze(F.regexp_replace(x, r"(?U)\s*\(.*?\)\s*", "")))
    return F.filter(parts, lambda x: x.rlike(r"^[A-ZÁÉÍÓÚÂÊÔÃÕÇ][A-ZÁÉÍÓÚÂÊÔÃÕÇ0-9\-]{1,14}$"))


def alias_line(original: Column, suggested: Column) -> Column:
    """One line of an alias table: "original": "suggested"."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.concat(F.lit("    "), quote(original), F.lit(": "), quote(suggested), F.lit(","))
