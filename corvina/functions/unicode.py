"""Unicode normal forms as Column builders, all in the JVM.

The tables come from the Python library's character database, by rule and once per process, and
reach Spark as the strings of ``translate`` or, where a character becomes several, as one text of
records. Composition looks only at texts that hold a character which it could change, and in those
only at characters with combining marks.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hangul syllables, composed by arithmetic: first syllable, first of the leading, vowel and trailing letters, and how many vowels and trails.
S, L, V, TRAIL, VOWELS, TRAILS = 0xAC00, 0x1100, 0x1161, 0x11A7, 21, 28
SYLLABLES = 19 * VOWELS * TRAILS
#: Part the records of a table and their two halves; no record holds them otherwise.
MARK, THEN = "\x01", "\x02"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


@lru_cache(1)
def _known() -> list[str]:
    """Characters that some normal form could change or move, syllables left out."""
    out = []
    for n in range(0x80, sys.maxunicode + 1):
        c = chr(n)
        if not S <= n < S + SYLLABLES and not 0xD800 <= n < 0xE000 and (unicodedata.decomposition(c) or unicodedata.combining(c)):
            out.append(c)
    return out


def _class(chars: Iterable[str]) -> str:
    """The characters as ranges of a regular expression's class, without its brackets."""
    out: list[list[int]] = []
    for n in sorted(map(ord, chars)):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out)


def _spelled(table: dict[str, str]) -> str:
    """A table as one text, of records that a mark opens: a character, another mark, its text."""
    return "".join(f"{MARK}{a}{THEN}{b}" for a, b in table.items()) + MARK


def _spread(spelled: str, c: Column) -> Column:
    """The text of a character that a table has."""
    behind = F.call_function("substring_index", F.lit(spelled), F.concat(F.lit(MARK), c, F.lit(THEN)), F.lit(-1))
    return F.substring_index(behind, MARK, 1)


def _each(c: Column, among: str, f: Callable[[Column], Column]) -> Column:
    """f of every character of a class, the rest of the text as it is."""
    parts = F.regexp_extract_all(c, F.lit(f"[{among}]|[^{among}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(f"^[{among}]$"), f(p)).otherwise(p)), "")


@lru_cache(1)
def _plain() -> tuple[str, str, str, str]:
    """How characters lose their accents: those with one plain character or none, what they become, the class of those with more, and their texts."""
    table = {c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in _known()}
    one, many = {a: b for a, b in table.items() if len(b) == 1}, {a: b for a, b in table.items() if len(b) > 1}
    return "".join(one) + "".join(a for a, b in table.items() if not b), "".join(one.values()), _class(many), _spelled(many)


def _letter(n: Column) -> Column:
    """The character of a code point below 65,536."""
    return F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")


def _without_syllables(c: Column) -> Column:
    """Hangul syllables as their letters."""
    among = f"\\x{{{S:X}}}-\\x{{{S + SYLLABLES - 1:X}}}"

    def letters(s: Column) -> Column:
        n = F.ascii(s) - S
        trail = F.when(n % TRAILS > 0, _letter(TRAIL + n % TRAILS)).otherwise("")
        return F.concat(_letter(L + F.floor(n / (VOWELS * TRAILS))), _letter(V + F.floor(n % (VOWELS * TRAILS) / TRAILS)), trail)

    return let(c, lambda t: F.when(t.rlike(f"[{among}]"), _each(t, among, letters)).otherwise(t))


def strip_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks; null stays null."""
    some, become, among, spelled = _plain()
    spread = lambda t: let(t, lambda u: F.when(u.rlike(f"[{among}]"), _each(u, among, lambda x: _spread(spelled, x))).otherwise(u))
    return let(c, lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), _without_syllables(spread(F.translate(t, some, become)))).otherwise(t))


@lru_cache(1)
def _decomposing() -> tuple[str, str]:
    """The class of characters with a canonical decomposition, and their decompositions."""
    return _class(_canonical()), _spelled(_canonical())


@lru_cache(1)
def _canonical() -> dict[str, str]:
    """Full canonical decompositions, syllables left out."""
    return {c: d for c in _known() if (d := unicodedata.normalize("NFD", c)) != c}


@lru_cache(1)
def _pairs() -> dict[str, dict[str, str]]:
    """For each character that composes with one before it: the ones before and what they become together."""
    out: dict[str, dict[str, str]] = {}
    for c in _known():
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", c) == c:
            a, b = (chr(int(p, 16)) for p in parts)
            out.setdefault(b, {})[a] = c
    return out


def _composed(a: Column, b: Column) -> Column:
    """What a starter and the character behind it become together, null if they stay two."""
    pairs = F.lit(_records())
    out = let(F.call_function("instr", pairs, F.concat(F.lit(MARK), a, b)), lambda at: F.when(at > 0, F.substring(pairs, at + 3, F.lit(1))))
    x, y = F.ascii(a), F.ascii(b)
    vowel = x.between(L, L + 18) & y.between(V, V + VOWELS - 1)
    trail = x.between(S, S + SYLLABLES - 1) & ((x - S) % TRAILS == 0) & y.between(TRAIL + 1, TRAIL + TRAILS - 1)
    return F.when(vowel, _letter(S + ((x - L) * VOWELS + y - V) * TRAILS)).when(trail, _letter(x + y - TRAIL)).otherwise(out)


@lru_cache(1)
def _records() -> str:
    """All composing pairs as records: a mark, the first, the second, what they become."""
    return "".join(f"{MARK}{first}{second}{both}" for second, firsts in _pairs().items() for first, both in firsts.items())


@lru_cache(1)
def _classes() -> dict[str, int]:
    return {c: n for c in _known() if (n := unicodedata.combining(c))}


@lru_cache(1)
def _ranks() -> tuple[str, str, str]:
    """Combining characters, a character for each one's class, and their class of a regular expression."""
    return "".join(_classes()), "".join(chr(0x100 + n) for n in _classes().values()), _class(_classes())


def _rank(c: Column) -> Column:
    """The combining class of a character, 0 for a starter."""
    marks, ranks, _ = _ranks()
    return let(F.translate(c, marks, ranks), lambda r: F.when(r == c, 0).otherwise(F.ascii(r) - 0x100))


def _compose(c: Column) -> Column:
    """A decomposed cluster composed: marks sorted within each starter, then drawn into it one by one."""
    marks = _ranks()[2]
    runs = F.regexp_extract_all(c, F.lit(f"[^{marks}]?[{marks}]+|[^{marks}]"), F.lit(0))
    kind = "struct<rank:int,i:int,c:string>"

    def ordered(run: Column) -> Column:
        chars = F.regexp_extract_all(run, F.lit("(?s)."), F.lit(0))
        return F.array_sort(F.transform(chars, lambda x, i: F.struct(_rank(x).cast("int").alias("rank"), i.alias("i"), x.alias("c")).cast(kind)))

    chars = F.flatten(F.transform(runs, ordered))
    state = "struct<done:string,starter:string,tail:string,last:int>"
    at = lambda done, starter, tail, last: F.struct(done.alias("done"), starter.alias("starter"), tail.alias("tail"), last.alias("last")).cast(state)
    empty = F.lit("")

    def step(s: Column, x: Column) -> Column:
        free = (s["starter"] != "") & ((s["tail"] == "") | ((s["last"] < x["rank"]) & (x["rank"] > 0)))
        both = F.when(free, _composed(s["starter"], x["c"]))
        whole = lambda b: F.when(b.isNotNull(), at(s["done"], b, s["tail"], s["last"])).when(x["rank"] == 0, at(F.concat(s["done"], s["starter"], s["tail"]), x["c"], empty, F.lit(0))).otherwise(at(s["done"], s["starter"], F.concat(s["tail"], x["c"]), x["rank"]))
        return F.get(F.transform(F.array(both), whole), F.lit(0))

    return F.aggregate(chars, at(empty, empty, empty, F.lit(0)), step, lambda s: F.concat(s["done"], s["starter"], s["tail"]))


def _decomposed(c: Column) -> Column:
    """The full canonical decomposition of a short text."""
    among, spelled = _decomposing()
    chars = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    return _without_syllables(F.array_join(F.transform(chars, lambda x: F.when(x.rlike(f"[{among}]"), _spread(spelled, x)).otherwise(x)), ""))


@lru_cache(1)
def _may_change() -> tuple[str, str]:
    """Classes of the characters that compose with one before them or move, and of those that no composed text holds."""
    behind = {*_pairs(), *_classes(), *map(chr, range(V, V + VOWELS)), *map(chr, range(TRAIL + 1, TRAIL + TRAILS))}
    behind |= {c for c, d in _canonical().items() if d[0] in behind}
    return _class(behind), _class(c for c in _known() if unicodedata.normalize("NFC", c) != c)


def nfc(c: Column) -> Column:
    """Unicode normal form C; null stays null. A text of Latin letters without marks is only tested, not taken apart."""
    behind, never = _may_change()

    def composed(t: Column) -> Column:
        parts = F.regexp_extract_all(t, F.lit(f"(?s)[^{behind}]?[{behind}]+|[{never}]|(?:[^{behind}{never}](?![{behind}]))+"), F.lit(0))
        return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(f"[{behind}{never}]"), _compose(_decomposed(p))).otherwise(p)), "")

    return let(c, lambda t: F.when(t.rlike(r"[^\x{0}-\x{2FF}]") & t.rlike(f"[{behind}{never}]"), composed(t)).otherwise(t))
