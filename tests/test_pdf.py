"""PDF files written here, read as runs, formed to lines and tables, and put through the table operators."""

import zlib

import pytest
from pyspark.sql import functions as F

from corvina.operators import layout
from corvina.operators import tables as R

WIDTH = 500  # of every glyph, in thousandths of its size


class Writer:
    """A small PDF: objects one after the other, a table of their places at the end."""

    def __init__(self):
        self.objects = {}

    def add(self, n, body, stream=None):
        if stream is None:
            self.objects[n] = body.encode("latin-1")
        else:
            self.objects[n] = f"<<{body} /Length {len(stream)}>>\nstream\n".encode("latin-1") + stream + b"\nendstream"

    def bytes(self, root, broken=False):
        out, places = b"%PDF-1.5\n", {}
        for n, body in self.objects.items():
            places[n] = len(out)
            out += b"%d 0 obj\n" % n + body + b"\nendobj\n"
        at = len(out) + (7 if broken else 0)
        top = max(self.objects) + 1
        out += b"xref\n0 %d\n0000000000 65535 f \n" % top + b"".join(b"%010d 00000 n \n" % places[n] if n in places else b"0000000000 00000 f \n" for n in range(1, top))
        return out + b"trailer\n<</Size %d /Root %d 0 R>>\nstartxref\n%d\n%%%%EOF" % (top, root, at)

    def bytes_with_streams(self, root):
        """Objects without streams within an object stream, places in a stream with predicted rows, as files since version 1.5 have them."""
        held = {n: b for n, b in self.objects.items() if b"stream" not in b}
        head, body = "", b""
        for n, b in held.items():
            head += f"{n} {len(body)} "
            body += b + b" "
        self.objects = {n: b for n, b in self.objects.items() if n not in held}
        holder, table = max([*held, *self.objects]) + 1, max([*held, *self.objects]) + 2
        self.add(holder, f"/Type /ObjStm /N {len(held)} /First {len(head)} /Filter /FlateDecode", zlib.compress(head.encode() + body))
        out, places = b"%PDF-1.5\n", {}
        for n, b in self.objects.items():
            places[n] = len(out)
            out += b"%d 0 obj\n" % n + b + b"\nendobj\n"
        rows = []
        for n in range(table + 1):
            kind, x, y = (1, len(out), 0) if n == table else (1, places[n], 0) if n in places else (2, holder, list(held).index(n)) if n in held else (0, 0, 0)
            rows.append(bytes([kind]) + x.to_bytes(4, "big") + y.to_bytes(2, "big"))
        last, predicted = bytes(7), b""
        for r in rows:
            predicted += b"\x02" + bytes((a - b) & 255 for a, b in zip(r, last))
            last = r
        packed = zlib.compress(predicted)
        start = len(out)
        out += b"%d 0 obj\n" % table + f"<</Type /XRef /Size {table + 1} /W [1 4 2] /Root {root} 0 R /Filter /FlateDecode /DecodeParms <</Predictor 12 /Columns 7>> /Length {len(packed)}>>".encode() + b"\nstream\n" + packed + b"\nendstream\nendobj\n"
        return out + b"startxref\n%d\n%%%%EOF" % start


def escaped(t):
    return t.encode("cp1252").replace(b"\\", rb"\\").replace(b"(", rb"\(").replace(b")", rb"\)")


def content(shown):
    """Strings at places: (x, y, text)."""
    return b"BT /F1 10 Tf\n" + b"".join(b"1 0 0 1 %d %d Tm (%s) Tj\n" % (x, y, escaped(t)) for x, y, t in shown) + b"ET"


def pdf(pages, how="plain", pad=0):
    w = Writer()
    w.add(1, "<</Type /Catalog /Pages 2 0 R>>")
    w.add(2, f"<</Type /Pages /Kids [{' '.join(f'{10 + 2 * i} 0 R' for i in range(len(pages)))}] /Count {len(pages)} /Resources <</Font <</F1 3 0 R>>>>>>")
    w.add(3, f"<</Type /Font /Subtype /TrueType /BaseFont /X /Encoding /WinAnsiEncoding /FirstChar 0 /LastChar 255 /Widths [{' '.join([str(WIDTH)] * 256)}]>>")
    for i, shown in enumerate(pages):
        w.add(10 + 2 * i, f"<</Type /Page /Parent 2 0 R /Contents {11 + 2 * i} 0 R>>")
        body = content(shown) if not isinstance(shown, bytes) else shown
        w.add(11 + 2 * i, "/Filter /FlateDecode", zlib.compress(body)) if not pad else w.add(11 + 2 * i, "", body + b" " * pad)
    return w.bytes_with_streams(1) if how == "streams" else w.bytes(1, broken=how == "broken")


def table(rows, at, left=50, step=150, lead=20):
    return [(left + step * k, at - lead * i, t) for i, row in enumerate(rows) for k, t in enumerate(row) if t]


RISKS = [["Risco", "Probabilidade", "Impacto", "Tratamento"], ["Fornecedor falha", "provável", "alto", "mitigar"], ["Falta de equipe", "raro", "médio", "aceitar"]]
DELIVERIES = [["Serviço/Ação", "Produto", "Eixo", "Data Entrega"], ["Portal", "Integração ao Login Único", "", "12/2025"], ["App (novo)", "Outros", "Canais", ""]]


def write(folder, name, data):
    (folder / name).write_bytes(data)


@pytest.mark.parametrize("how", ["plain", "streams", "broken"])
def test_tables_of_a_file(spark, tmp_path, how):
    """Title, paragraph and two tables on two pages; the file's own table of places plain, in a stream, or wrong."""
    pages = [[(50, 800, "Plano"), *table(RISKS, 740), (50, 600, "Texto longo que segue a tabela"), (50, 588, "e mais uma linha")], table(DELIVERIES, 700)]
    write(tmp_path, "plano.pdf", pdf(pages, how))
    runs, errors = layout.read_pdf(spark, str(tmp_path))
    assert errors.isEmpty()
    grid = layout.tables(runs)
    got = sorted((r["doc"], r["page"], r["tbl"], r["header"], r["rows"]) for r in grid.collect())
    assert got == [("plano", 1, 0, RISKS[0], RISKS[1:]), ("plano", 2, 0, DELIVERIES[0], DELIVERIES[1:])]
    assert [r["text"] for r in layout.lines(runs).where("page = 1").orderBy("line").collect()] == ["Plano", *[" ".join(r) for r in RISKS], "Texto longo que segue a tabela", "e mais uma linha"]
    risks = R.risk_rows(grid).orderBy("row").collect()
    assert [(r["risk"], r["probability"], r["impact"], r["treatment"]) for r in risks] == [tuple(r) for r in RISKS[1:]]


def test_byte_ranges_read_each_page_once(spark, tmp_path):
    pages = [[(50, 700, f"page {i} of the long file")] for i in range(40)]
    write(tmp_path, "long.pdf", pdf(pages, pad=5000))
    whole = layout.read_pdf(spark, str(tmp_path))[0]
    parted = layout.read_pdf(spark, str(tmp_path), range_bytes="30000")[0]
    assert whole.rdd.getNumPartitions() == 1 < 5 < parted.rdd.getNumPartitions()
    texts = lambda df: [(r["page"], r["text"]) for r in df.orderBy("page", "run").collect()]
    assert texts(whole) == texts(parted) == [(i + 1, f"page {i} of the long file") for i in range(40)]


def test_operators_of_content(spark, tmp_path):
    """Escapes, kerning as blanks, moves by Td, TD, T* and quotes, scaled space, octal codes, hex strings."""
    body = rb"q 2 0 0 2 10 20 cm BT /F1 5 Tf 12 TL 100 300 Td [(Re) -20 (sumo) -400 (final)] TJ T* (a\(b\)\\c \351) Tj (quoted) ' 0 -30 TD <4142> Tj ET Q BT /F1 8 Tf 1 0 0 1 300 50 Tm (outside) Tj ET"
    write(tmp_path, "x.pdf", pdf([body]))
    got = layout.read_pdf(spark, str(tmp_path))[0].orderBy("run").collect()
    assert [(r["text"], r["x"], r["y"]) for r in got] == [("Resumo final", 210, 620), ("a(b)\\c é", 210, 596), ("quoted", 210, 572), ("AB", 210, 512), ("outside", 300, 50)]
    assert got[0]["size"] == 10 and got[3]["width"] == pytest.approx(10)


def test_fonts_that_map_codes(spark, tmp_path):
    """Two-byte codes by a character map, and names of glyphs."""
    w = Writer()
    w.add(1, "<</Type /Catalog /Pages 2 0 R>>")
    w.add(2, "<</Type /Pages /Kids [4 0 R] /Count 1>>")
    w.add(4, "<</Type /Page /Contents [5 0 R 6 0 R] /Resources <</Font <</A 7 0 R /B 8 0 R>>>>>>")
    w.add(5, "", b"BT /A 10 Tf 50 700 Td <000100020005> Tj ET")
    w.add(6, "", b"BT /B 10 Tf 50 600 Td (abc) Tj ET")
    w.add(7, "<</Type /Font /Subtype /Type0 /ToUnicode 9 0 R /DescendantFonts [<</DW 900 /W [1 [400 600] 5 6 700]>>]>>")
    w.add(8, "<</Type /Font /Subtype /Type1 /Encoding <</Differences [97 /atilde /one /uni00E7]>>>>")
    w.add(9, "", b"1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <00E7> <0002> <00660069> endbfchar 1 beginbfrange <0004> <0006> <0061> endbfrange")
    write(tmp_path, "f.pdf", w.bytes(1))
    got = layout.read_pdf(spark, str(tmp_path))[0].orderBy(F.desc("y")).collect()
    assert [r["text"] for r in got] == ["çfib", "ã1ç"] and got[0]["width"] == pytest.approx(17)


def test_unreadable_files_are_rows(spark, tmp_path):
    write(tmp_path, "junk.pdf", b"not a document")
    write(tmp_path, "empty.pdf", b"")
    write(tmp_path, "filter.pdf", pdf([[(1, 1, "x")]]).replace(b"FlateDecode", b"OtherDecode"))
    write(tmp_path, "good.pdf", pdf([[(50, 700, "fine")]]))
    write(tmp_path, "notes.txt", b"no document either")
    runs, errors = layout.read_pdf(spark, str(tmp_path))
    assert [r["text"] for r in runs.collect()] == ["fine"]
    got = {r["path"].rsplit("/", 1)[1]: r["error"].split(":")[0] for r in errors.collect()}
    assert got == {"junk.pdf": "pdf_open_failed", "empty.pdf": "pdf_open_failed", "filter.pdf": "page_failed"}
    assert layout.read_pdf(spark, f"file://{tmp_path}/good.pdf")[0].first()["doc"] == "good"


RUNS = "doc string, page int, x double, y double, width double, size double, text string"


def test_layout_of_awkward_runs(spark):
    """Nulls, words of one cell in pieces, uneven baselines, wrapped cells, a short table, no rows at all."""
    rows = [("d", 1, None, 1.0, 1.0, 10.0, "lost"), ("d", 1, 1.0, 1.0, 1.0, 0.0, "lost"), ("d", 1, 1.0, 1.0, 1.0, 10.0, None)]
    rows += [("d", 2, 50 + 150.0 * k + dx, 697.0 + dy, 20.0, 10.0, t) for k, (dx, dy, t) in enumerate([(0, 0, "A"), (0, 1, "B"), (0, -1, "C")])]
    rows += [("d", 2, 50.0, 670.0, 25.0, 10.0, "uma"), ("d", 2, 77.0, 670.0, 30.0, 10.0, "linha"), ("d", 2, 107.5, 670.0, 10.0, 10.0, "s"), ("d", 2, 200.0, 670.0, 30.0, 10.0, "dois"), ("d", 2, 350.0, 670.0, None, 10.0, "x")]
    rows += [("d", 2, 200.0, 658.0, 40.0, 10.0, "partes"), ("d", 2, 50.0, 630.0, 25.0, 10.0, "fim"), ("d", 2, 350.0, 630.0, 9.0, 10.0, "y"), ("d", 2, 50.0, 600.0, 25.0, 10.0, "z"), ("d", 2, 200.0, 600.0, 9.0, 10.0, "w")]
    rows += [(None, 1, 50.0 + 150 * k, 700.0 - 20 * i, 20.0, 10.0, f"{i}{k}") for i in range(2) for k in range(3)]
    rows += [("two", 1, 50.0 + 150 * k, 700.0 - 20 * i, 20.0, 10.0, "v") for i in range(3) for k in range(2)]
    df = spark.createDataFrame(rows, RUNS)
    got = {(r["doc"], r["page"]): (r["header"], r["rows"]) for r in layout.tables(df).collect()}
    assert got == {("d", 2): (["A", "B", "C"], [["uma linhas", "dois partes", "x"], ["fim", "", "y"], ["z", "w", ""]]), (None, 1): (["00", "01", "02"], [["10", "11", "12"]])}
    assert layout.tables(df.limit(0)).isEmpty() and layout.lines(df.limit(0)).isEmpty()
