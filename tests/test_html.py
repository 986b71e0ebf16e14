"""Pages read by their elements: quotes, nested tags, entities, open tags, scripts; bodies, their documents and groups."""

from corvina.sources import html

PREFIX = r"Plano\s+de\s+Transforma[çc][ãa]o\s+Digital"
KINDS = (("directive", ("diretivo",)), ("delivery", ("entregas", "anexo")))
INDEX = """<html><!-- <a href="x.pdf">no</a> --><script>var a = '<a href="y.pdf">no</a>';</script><table><tr>
<td><strong>Plano de Transforma&ccedil;&atilde;o <em>Digital</em> AAA / BBB:</strong> <a href='/x/ptds-vigentes/1.pdf'>Documento <i>Dire</i>tivo</a> / <a class=k href="http://h/ptds-vigentes/2.PDF">Anexo de &quot;Entregas&quot;</a></td>
<td><b>Plano de Transformação Digital CCC (NOVO) -</b><p><a href="/x/ptds-vigentes/c.pdf">arquivo</a><a href="/x/ptds-vigentes/c_entregas.pdf">baixar</a><a href="/elsewhere/z.pdf">diretivo</a><a name="k">none</a></td>
<td><strong>Outra coisa DDD</strong><a href="/x/ptds-vigentes/d.pdf">diretivo</a></td>
<td><strong>Plano de Transformação Digital BBB / AAA</strong><a href="/x/ptds-vigentes/again.pdf">diretivo</a></td>
<td><strong>Plano de Transformação Digital BBB</strong></td></tr></table><div><strong>Plano de Transformação Digital EEE:</strong></div></div></html>"""


def test_marks(spark):
    df = spark.createDataFrame([(1, INDEX), (2, None), (3, ""), (4, "<a href=q>one<br/>two <b>three</b></p>")], "id int, page string")
    got = html.page_marks(df, "id", "page").orderBy("id", "seq").collect()
    assert [(r["id"], r["href"], r["text"]) for r in got if r["kind"] == "link"][:2] == [(1, "/x/ptds-vigentes/1.pdf", "Documento Dire tivo"), (1, "http://h/ptds-vigentes/2.PDF", 'Anexo de "Entregas"')]
    assert [r["text"] for r in got if r["kind"] == "heading"][0] == "Plano de Transformação Digital AAA / BBB:"
    assert [(r["kind"], r["text"]) for r in got if r["id"] == 4] == [("link", "one two three"), ("heading", "three")]
    assert not any(r["href"] in ("x.pdf", "y.pdf") for r in got) and {r["id"] for r in got} == {1, 4}


def test_bodies(spark):
    df = spark.createDataFrame([(1, INDEX), (2, "<td><b>Plano de Transformação Digital AAA</b></td>")], "id int, page string")
    groups = spark.createDataFrame([("CCC", "CCC"), ("CCC", "C1"), ("CCC", "EEE"), ("ZZZ", "Z1")], "head string, member string")
    out = html.bodies(df, "id", "page", prefix=PREFIX, says="transformacao digital", kinds=KINDS, folders=("ptds-vigentes/",), site="https://h", groups=groups)
    got = {(r["id"], r["owner"]): (r["first"], r["second"], r["inherited_from"]) for r in out.collect()}
    one, c = ("https://h/x/ptds-vigentes/1.pdf", "http://h/ptds-vigentes/2.PDF"), ("https://h/x/ptds-vigentes/c.pdf", "https://h/x/ptds-vigentes/c_entregas.pdf")
    assert got == {(1, "AAA"): (*one, None), (1, "BBB"): (*one, None), (1, "CCC"): (*c, None), (1, "C1"): (*c, "CCC"), (1, "EEE"): (*c, "CCC"), (2, "AAA"): (None, None, None)}
