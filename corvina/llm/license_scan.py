"""License scans by template markup.

A template is wording with optional regions ``[[ ... ]]`` and replaceable ones ``<<n>>`` (up
to n words of any kind). It compiles to an automaton over word tokens; a text matches where
the mandatory words stand exactly, in order, with nothing else between them. Plain phrases
are templates without regions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Parts of the license texts below.
_GRANT = "permission is hereby granted free of charge to any person obtaining a copy of this <<3>> and associated documentation files [[the <<2>>]] to deal in the <<2>> without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the <<2>>"
_FURNISHED = "and to permit persons to whom the <<2>> is furnished to do so"
_MIT_TAIL = "the <<2>> is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the <<6>> be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the <<2>> or the use or other dealings in the <<2>>"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_BSD_TWO = "[[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_ADS = "[[3]] all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by <<20>>"
_BSD_NAMES = "neither the name of <<12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_TAIL = "this software is provided by <<12>> as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<12>> be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_ISC = "permission to use copy modify and [[or]] distribute this software for any purpose with or without fee is hereby granted"
_ISC_NOTICE = "provided that the above copyright notice and this permission notice appear in all copies"
_ISC_TAIL = "the software is provided as is and <<6>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall <<6>> be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"
_GPL = "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version <<2>> of the license or [[at your option]] any later version"
_GPL_REST = "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program"
#: Templates and their labels: common notices, and common licenses by their whole mandatory wording or by their opening alone.
TEMPLATES = {
    "gpl-notice": ("[[this <<3>> is]] licensed under the [[terms of the]] gnu general public license version <<1>>",),
    "gpl-header": (f"{_GPL} {_GPL_REST}",),
    "gpl-opening": (_GPL,),
    "apache-2.0-notice": ("licensed under the apache license version 2 0 [[the license you may not use this file except in compliance with the license]]",),
    "mit-notice": ("[[this <<3>> is]] released under the [[terms of the]] mit license", "[[this <<3>> is]] licensed under the [[terms of the]] mit license"),
    "mit-text": (f"{_GRANT} {_FURNISHED} subject to the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the <<2>> {_MIT_TAIL}",),
    "mit-0-text": (f"{_GRANT} {_FURNISHED} {_MIT_TAIL}",),
    "mit-opening": (_GRANT,),
    "bsd-2-clause-text": (f"{_BSD} {_BSD_TWO} {_BSD_TAIL}",),
    "bsd-3-clause-text": (f"{_BSD} {_BSD_TWO} [[3]] {_BSD_NAMES} {_BSD_TAIL}",),
    "bsd-4-clause-text": (f"{_BSD} {_BSD_TWO} {_BSD_ADS} [[4]] {_BSD_NAMES} {_BSD_TAIL}",),
    "bsd-opening": (_BSD,),
    "isc-text": (f"{_ISC} {_ISC_NOTICE} {_ISC_TAIL}",),
    "0bsd-text": (f"{_ISC} {_ISC_TAIL}",),
    "isc-opening": (_ISC,),
    "cc-by-notice": ("licensed under [[a]] [[creative commons]] cc by <<1>> 0",),
    "cc-by-sa-notice": ("licensed under [[a]] [[creative commons]] cc by sa <<1>> 0",),
    "cc-by-nc-notice": ("licensed under [[a]] [[creative commons]] cc by nc <<1>> 0",),
    "cc-by-nd-notice": ("licensed under [[a]] [[creative commons]] cc by nd <<1>> 0",),
    "cc-by-nc-sa-notice": ("licensed under [[a]] [[creative commons]] cc by nc sa <<1>> 0",),
    "cc-by-nc-nd-notice": ("licensed under [[a]] [[creative commons]] cc by nc nd <<1>> 0",),
    "all-rights-reserved": ("all rights reserved",),
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ANY = None


@dataclass(frozen=True)
class Automaton:
    """States 0..n; moves by a word or by any word; free moves; the last state accepts."""

    moves: tuple[dict[bytes | None, int], ...]
    free: tuple[tuple[int, ...], ...]

    def close(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def first(self) -> set[bytes | None]:
        """The words a match can begin with."""
        return {w for s in self.close({0}) for w in self.moves[s]}

    def match(self, words: Sequence[bytes], at: int) -> int:
        """Words of the longest match from ``at``, 0 for none."""
        last, states, best = len(self.moves) - 1, self.close({0}), 0
        for k in range(at, len(words)):
            step = {t for s in states for w, t in self.moves[s].items() if w is ANY or w == words[k]}
            if not step:
                break
            states = self.close(step)
            if last in states:
                best = k - at + 1
        return best


def compile_template(template: str) -> Automaton:
    """The automaton of a template's markup."""
    moves: list[dict[bytes | None, int]] = [{}]
    free: list[list[int]] = [[]]

    def state() -> int:
        moves.append({})
        free.append([])
        return len(moves) - 1

    open_: list[int] = []
    here = 0
    for token in re.findall(r"\[\[|\]\]|<<\d+>>|[^\s\[\]<>]+", template):
        if token == "[[":
            there = state()
            free[here].append(there)
            open_.append(there)
            here = there
        elif token == "]]":
            there = state()
            free[here].append(there)
            free[open_.pop()].append(there)
            here = there
        elif token[:2] == "<<":
            steps = [here]
            for _ in range(int(token[2:-2])):
                there = state()
                moves[steps[-1]][ANY] = there
                steps.append(there)
            here = state()
            for s in steps[1:]:
                free[s].append(here)
        else:
            there = state()
            moves[here][token.encode()] = there
            here = there
    if open_:
        raise ValueError(f"an optional region isn't closed: {template}")
    end = state()
    free[here].append(end)
    return Automaton(tuple(moves), tuple(map(tuple, free)))


class Scanner:
    """Finds phrases and templates in the words of whole texts."""

    def __init__(self, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES):
        self.phrases = [(tuple(p.encode().split()), label) for p, label in phrases.items()]
        self.starts: dict[bytes, list[tuple[Automaton, str]]] = {}
        self.loose: list[tuple[Automaton, str]] = []
        for label, forms in templates.items():
            for form in forms:
                machine = compile_template(form)
                first = machine.first()
                if ANY in first:
                    self.loose.append((machine, label))
                for w in first - {ANY}:
                    self.starts.setdefault(w, []).append((machine, label))

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Number of words; base places and template places, each (first word, words, label)."""
        words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
        joined = b" " + b" ".join(words) + b" "
        base, places = [], []
        for phrase, label in self.phrases:
            needle, at, last, word = b" " + b" ".join(phrase) + b" ", -1, 0, -1
            while (at := joined.find(needle, at + 1)) >= 0:
                # Words are counted from the last place on, so a text is gone through once for each phrase.
                word += joined.count(b" ", last, at + 1)
                last = at + 1
                base.append((word, len(phrase), label))
        heads = [w for w in self.starts if b" " + w + b" " in joined]
        if heads:
            held = set(heads)
            for i, w in enumerate(words):
                if w in held:
                    places += [(i, n, label) for machine, label in self.starts[w] if (n := machine.match(words, i))]
        for machine, label in self.loose:
            places += [(i, n, label) for i in range(len(words)) if (n := machine.match(words, i))]
        return len(words), base, places


_FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, *, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, its words, the places of the base phrases and all labels.

    first_word and last_word are the smallest and largest start of a base place, null without
    one. Labels are distinct, sorted and comma-joined, empty for none. score is the share of the
    words inside a base or template place. Null and wordless texts have no words and score 0.
    """
    mine = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["id", *(x.split()[0] for x in _FOUND.split(", "))]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            out: list[list] = [[] for _ in kinds]
            for text in batch.column(1).to_pylist():
                n, base, places = scanner.scan(text)
                inside = {k for at, m, _ in (*base, *places) for k in range(at, at + m)} if base or places else ()
                at = [x[0] for x in base]
                own = {x[2] for x in base}
                row = (n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(own | {x[2] for x in places})), len(inside) / n if n else 0.0)
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds))], names)

    fields = ", ".join([f"id {mine.schema['id'].dataType.simpleString()}", _FOUND])
    return mine.mapInArrow(run, fields)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, base phrase places, labels of phrases and templates."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")


QUERIES = {"op9_license_scan": op9_license_scan}
ORACLES: dict[str, str] = {}
