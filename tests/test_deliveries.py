"""Deliveries by names, by a first row of names, by values; headers that are deliveries; what is left out."""

from pyspark.sql import functions as F

from corvina.operators.deliveries import catalogue_deliveries
from corvina.sources.shared import sized

GRID = "doc string, page int, tbl int, header array<string>, rows array<array<string>>"
LOGIN, LGPD, EVOLVED = "Integração ao Login Único", "Adequação à LGPD", "Evolução do Serviço"


def read(spark, *tables):
    got = catalogue_deliveries(spark.createDataFrame([(*t,) for t in tables], GRID).repartition(3)).collect()
    return {(r["doc"], r["page"], r["row"]): r for r in got}


def brief(r):
    return r["service"], r["original"], r["product"], r["axis"]


def test_columns_by_value(spark):
    """No names anywhere: the first cell that names a product tells its column, its neighbours service and axis."""
    got = read(spark, ("d", 1, 0, ["a", "b", "c", "d"], [["x", "Portal", LOGIN, "Canais"], ["y", "App", "Adequacao a LGPD", ""], ["z", "Chat", "nada disso", ""]]))
    assert {k: brief(r) for k, r in got.items()} == {("d", 1, 0): ("Portal", LOGIN, LOGIN, "Unificação de Canais Digitais"), ("d", 1, 1): ("App", "Adequacao a LGPD", LGPD, "Governança e Gestão de Dados")}


def test_names_in_the_first_row(spark):
    got = read(spark, ("d", 1, 0, ["1", "2", "3"], [["Produto", "Serviço", "Prazo"], [LOGIN, "Portal", "12/2025"], ["Produto", "Serviço", "Prazo"]]))
    assert list(got) == [("d", 1, 1)] and brief(got["d", 1, 1])[:2] == ("Portal", LOGIN) and got["d", 1, 1]["due"] == "2025-12"


def test_named_columns_and_pages_that_go_on(spark):
    """A later table without names is read by places; its header, where that is a delivery, comes back for review."""
    names = ["Serviço/Ação", "Produto", "Eixo", "Área responsável", "Data Pactuada"]
    got = read(
        spark,
        ("d", 0, 0, ["x", "y"], [["Outros", "Outros"]]),
        ("d", 1, 0, names, [["Portal", LOGIN, "Canais", "TI", "jun/25"], ["None", "", "", "", ""], ["Fila", "nan", LGPD, "", ""], ["Produto", "produto ptd", "", "", ""], ["Outro", "Outros -", "Canais", "", ""]]),
        ("d", 2, 0, ["Balcão", EVOLVED, "Eixo", "TI"], [["Chat", "Evolucao do Servico Dig", "", "03/2026"], ["Mapa", LGPD, "", ""]]),
        ("d", 3, 0, ["Balcão", EVOLVED, "Eixo", "TI", "12/2026"], [["Chat", LOGIN, "", "TI", "03/2026"]]),
        ("other", 1, 0, ["a", "b", "c"], [["nothing", "of", "the kind"]]),
    )
    assert set(got) == {("d", 1, 0), ("d", 1, 2), ("d", 1, 4), ("d", 2, -1), ("d", 2, 0), ("d", 2, 1), ("d", 3, 0)}
    assert got["d", 1, 0]["due"] == "2025-06" and not got["d", 1, 0]["needs_review"] and got["d", 1, 0]["confidence"] == "high"
    assert brief(got["d", 1, 2])[:3] == ("Fila", LGPD, LGPD)
    assert got["d", 1, 4]["review_reason"] == "produto Outros" and got["d", 1, 4]["product"] == "Outros"
    lifted = got["d", 2, -1]
    assert brief(lifted)[:3] == ("Balcão", EVOLVED, EVOLVED) and (lifted["confidence"], lifted["review_reason"]) == ("medium", "recuperado de header multi-página")
    assert got["d", 2, 0]["review_reason"] == "fuzzy=0.90" and got["d", 2, 0]["confidence"] == "medium" and got["d", 2, 0]["due"] == "2026-03"
    assert got["d", 3, 0]["due"] == "2026-03"


def test_states(spark):
    got = read(
        spark,
        ("a", 1, 0, ["Serviço", "Produto", "Status", "Data Entrega"], [["s", LOGIN, "cancelado", ""], ["s", LOGIN, "", "12/2025"], ["s", LOGIN, "em andamento", ""]]),
        ("b", 1, 0, ["Serviço", "Produto", "Justificativa"], [["s", LOGIN, "x" * 600]]),
    )
    assert [got["a", 1, i]["state"] for i in range(3)] == ["cancelada", "concluida", "pactuada"] and got["a", 1, 1]["delivered"] == "2025-12"
    assert got["b", 1, 0]["state"] == "cancelada" and len(got["b", 1, 0]["reason"]) == 500


def test_awkward_tables(spark):
    """Null cells, rows of uneven length, a null document, tables without rows, decomposed text, no tables."""
    got = read(spark, (None, 1, 0, ["Serviço", "Produto", None], [[None, None, None], ["s"], ["s", "Integração ao Login Único", None, "more"], []]), ("e", 1, 0, ["Serviço", "Produto", "Eixo"], []), ("n", 1, 0, None, None))
    assert {k: r["product"] for k, r in got.items()} == {(None, 1, 2): LOGIN}
    assert not read(spark, ("n", 1, 0, [], []))


def test_large_sides_are_never_broadcast(spark, tmp_path):
    """However small Spark takes the tables' files for, no join of unpacked rows broadcasts them."""
    names = ["Serviço", "Produto", "Prazo"]
    spark.createDataFrame([("d", 1, 0, names, [["Portal", LOGIN, "12/2025"]])], GRID).write.parquet(f"{tmp_path}/grid")
    got = catalogue_deliveries(spark.read.parquet(f"{tmp_path}/grid"))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 1
    few, many = (spark.range(n).select(F.col("id").cast("string").alias("k")) for n in (10, 50))
    assert {sized(few, most).join(sized(many, most), "k").count() for most in (0, 20, 100)} == {10}
    plan = lambda df: spark.range(3).select(F.col("id").cast("string").alias("k")).join(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan(sized(few, 20)) and "Broadcast" not in plan(sized(many, 20)) and "Broadcast" not in plan(sized(few, 20, 5))
