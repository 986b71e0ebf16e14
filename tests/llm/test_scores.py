"""Toxicity, quality, licenses: held-out accuracy and brute force."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvina.llm import license_scan, quality, toxicity
from corvina.llm.labelled import fold, sample

SF = "/root/testdata/sf0.01"


def accuracy(spark, query, label):
    got = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= 0.7).astype(int) == got.predicted).all()
    return (got.predicted == got[label]).mean()


def test_toxicity_held_out(spark):
    assert accuracy(spark, toxicity.op8_toxicity, "toxic") >= 0.93


def test_quality_held_out(spark):
    assert accuracy(spark, quality.op10_quality, "quality") >= 0.97


def test_folding_and_exceptions():
    assert toxicity.fold_text("You 1d10t!") == " you idiot "
    assert toxicity.fold_text("lоser") == " loser "  # a Cyrillic o
    assert toxicity.fold_text("call 555 0134") == " call 555 0134 " and toxicity.fold_text(None).strip() == ""
    lex = toxicity.Lexicon({" trash ": 2.0, " low": 1.0})
    weigh = lex.matcher()
    assert weigh(toxicity.fold_text("Trash can. trash")) == 2.0 and weigh(toxicity.fold_text("lower low")) == 2.0 and weigh(" ") == 0.0


def test_learning_needs_rows():
    assert toxicity.learn([]).weights == toxicity.DEFAULT_LEXICON
    rows = [(f"you and plain{i} with word{i} here {i}", 0) for i in range(60)] + [(f"you and vilex{i} with vileq{i} here {i}", 1) for i in range(60)]
    lex = toxicity.learn(rows)
    assert all(p.startswith(" vile") for p in lex.weights)
    weigh = lex.matcher()
    s = lex.score(np.array([weigh(" you vilexcat and vileqfox are here "), weigh(" you and a cat are here ")]), np.array([36.0, 24.0]))
    assert s[0] > 0.7 > s[1]


def test_scores_of_edges(spark, docs, none):
    for got in (toxicity.score(docs, toxicity.Lexicon()), quality.score(docs, quality.learn(np.zeros((0, len(quality.FEATURES))), np.zeros(0)))):
        assert got.columns == [*docs.columns, "score"] and got.where("score between 0 and 1").count() == docs.count()
    assert toxicity.score(none, toxicity.Lexicon()).isEmpty()
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    assert sample(docs, labels, "toxic", folds=3, held_out=9, per_class=(5, 5)).count() == 2
    assert toxicity.reject_toxic(docs, labels.where("false")).columns == docs.columns


def test_fold(spark):
    import zlib

    got = spark.range(50).select("id", fold(F.col("id"), 3).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in got)


def test_additive_learns_an_interaction():
    r = np.random.default_rng(1)
    x = np.zeros((3000, len(quality.FEATURES)))
    x[:, :2] = r.random((3000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.learn(x, y)
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.95 and model.pairs


@pytest.mark.parametrize("text, labels", [("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-notice"), ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-notice"), ("licensed under the terms of the MIT License", "mit,mit-notice"), ("licensed under some other MIT License", "mit"), ("All rights\nreserved", "all-rights-reserved"), (None, ""), ("", "")])
def test_license_labels(spark, text, labels):
    row = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["labels"] == labels


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
MIT_0 = re.sub(r", subject to.*?portions of the Software", "", MIT, flags=re.S)
NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
BSD_3 = f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{NAMES}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ADS = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the Example Project.\n4. "
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program."""


@pytest.mark.parametrize("text, label, opening", [(MIT, "mit-text", "mit-opening"), (MIT_0, "mit-0-text", "mit-opening"), (BSD_3.replace(NAMES, ""), "bsd-2-clause-text", "bsd-opening"), (BSD_3, "bsd-3-clause-text", "bsd-opening"), (BSD_3.replace("3. ", ADS), "bsd-4-clause-text", "bsd-opening"), (ISC, "isc-text", "isc-opening"), (re.sub(", provided that.*?copies", "", ISC), "0bsd-text", "isc-opening"), (GPL, "gpl-header", "gpl-opening")])
def test_whole_licenses(text, label, opening):
    scanner = license_scan.Scanner()
    n, _, places = scanner.scan(text)
    assert {x[2] for x in places} == {label, opening} and (0, n, label) in places
    # A word altered near the end, or the end cut off, leaves the opening alone.
    words = text.split()
    for other in ([*words[:-8], "altered", *words[-7:]], words[:-1]):
        assert {x[2] for x in scanner.scan(" ".join(other))[2]} == {opening}


def test_templates():
    a = license_scan.compile_template("a [[b <<2>>]] c")
    words = lambda s: [w.encode() for w in s.split()]
    assert [a.match(words(s), 0) for s in ("a c", "a b x c", "a b x y c", "a b x y z c", "a b c", "b c")] == [2, 4, 5, 0, 0, 0]
    with pytest.raises(ValueError, match="closed"):
        license_scan.compile_template("a [[b")


def test_base_phrases_by_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["id"]: r for r in license_scan.scan_licenses(rows).collect()}
    for r in rows.select("doc_id", "text").collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        places = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        x = got[r["doc_id"]]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({b for _, b in places})))
