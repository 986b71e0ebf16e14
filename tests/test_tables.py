"""Raw tables of every kind by hand, each with what the operators make of them."""


import pytest
from pyspark.sql import functions as F

from corvina.functions.vocabularies import AXIS, IMPACT_SCALE, PROBABILITY_SCALE, PRODUCT, TREATMENTS
from corvina.operators import tables as R

GRID = "doc string, page int, tbl int, header array<string>, rows array<array<string>>"
_RISK = ["Risco", "Probabilidade", "Impacto", "Tratamento", "Ações"]
GRIDS = [
    ("d1", 1, 0, ["Órgão", "Sigla", "CNPJ"], [["Ministério", "MX", "1"]]),
    ("d1", 1, 1, ["Nome", "Cargo", "Assinatura"], [["A", "B", ""]]),
    ("d1", 2, 0, _RISK, [["[1 raro a praticamente certo]", "", "", "", ""], ["Fornecedor falha", "provável", "alto", "mitigar", "1, 2"], ["Falta de equipe", "raro", "médio", "aceitar", "treinar"]]),
    ("d1", 3, 0, ["Col0", "Col1", "Col2", "Col3", "Col4"], [["Risco", "Probabilidade", "Impacto", "Tratamento", "Ações"], ["Dados perdidos", "alto", "raro", "mitigar", "2"]]),
    ("d2", 1, 0, ["Vazamento de dados", "pouco provável", "alto", "mitigar", "3"], [["Greve geral longa", "raro", "baixo", "aceitar", ""]]),
    ("d3", 1, 0, [f"c{i}" for i in range(9)], [["risco"] * 9]),
    ("d4", 1, 0, ["Serviço/Ação", "Produto", "Eixo", "Data Entrega", "Situação"], [["Portal", "Login", "Canais", "12/2025", "Concluído"], ["App", "Outros", "Canais", "", "cancelada"], ["Produto", "Produto", "Eixo", "", ""]]),
    ("d4", 2, 0, ["Balcão", "Agenda", "Serviços", "jun/25", ""], [["Chat", "Bot", "Serviços", "", "em andamento"]]),
]


def grid(spark):
    """Tables of all the kinds the operators tell apart."""
    return spark.createDataFrame(GRIDS, GRID)


CASES = {}


def _sql(rows, cols):
    return rows, cols.split(", ")


def query(name, want):
    return lambda f: CASES.setdefault(name, (want, f))[1]


@query("table_classify", _sql([
    ("d1", 1, 0, "organ_info", "unknown", False, False), ("d1", 1, 1, "signature", "unknown", False, False), ("d1", 2, 0, "risk_table", "unknown", False, False), ("d1", 3, 0, "risk_table", "unknown", False, False),
    ("d2", 1, 0, "unknown", "unknown", True, False), ("d3", 1, 0, "unknown", "unknown", False, False), ("d4", 1, 0, "unknown", "done", False, False), ("d4", 2, 0, "unknown", "unknown", False, False),
], "doc, page, tbl, directive, delivery, header_data, orphan"))
def table_classify(spark, sf_dir):
    """The kinds of the sample tables."""
    return grid(spark).select("doc", "page", "tbl", R.directive_kind().alias("directive"), R.delivery_kind().alias("delivery"), R.header_is_data().alias("header_data"), (R.is_orphan() & (R.directive_kind() != "risk_table")).alias("orphan"))


@query("risk_extraction", _sql([
    ("d1", 2, 1, "Fornecedor falha", "provável", "alto", "mitigar", "1, 2"), ("d1", 2, 2, "Falta de equipe", "raro", "médio", "aceitar", "treinar"), ("d1", 3, 1, "Dados perdidos", "alto", "raro", "mitigar", "2"),
    ("d2", 1, -1, "Vazamento de dados", "pouco provável", "alto", "mitigar", "3"), ("d2", 1, 0, "Greve geral longa", "raro", "baixo", "aceitar", ""),
], "doc, page, row, risk, probability, impact, treatment, actions"))
def risk_extraction(spark, sf_dir):
    """Risks of the sample tables: under a header, going on over a page, and in a header's place."""
    return R.risk_rows(grid(spark)).select("doc", "page", "row", "risk", "probability", "impact", "treatment", "actions")


@query("risk_swap", _sql([("Fornecedor falha", "provável", "alto", False), ("Falta de equipe", "raro", "médio", False), ("Dados perdidos", "raro", "alto", True), ("Vazamento de dados", "pouco provável", "alto", False), ("Greve geral longa", "raro", "baixo", False)], "risk, probability, impact, swapped"))
def risk_swap(spark, sf_dir):
    """Probability and impact exchanged back where each fits the other's scale only."""
    rows = R.risk_rows(grid(spark)).select("risk", "probability", "impact")
    return R.swap_columns(rows, "probability", "impact", PROBABILITY_SCALE, IMPACT_SCALE)


@query("delivery_extraction", _sql([("d4", 1, 0, "Login", "Portal", "Canais", None, "2025-12", "concluida"), ("d4", 1, 1, "Outros", "App", "Canais", None, None, "cancelada"), ("d4", 2, -1, "Agenda", "Balcão", "Serviços", None, "2025-06", "concluida"), ("d4", 2, 0, "Bot", "Chat", "Serviços", None, None, "pactuada")], "doc, page, row, product, service, axis, due, delivered, state"))
def delivery_extraction(spark, sf_dir):
    """Deliveries of the sample tables, the second going on without a header."""
    return R.table_deliveries(grid(spark)).select("doc", "page", "row", "product", "service", "axis", F.col("due").cast("string").alias("due"), "delivered", "state")


_ROLES = [("Situação", "status"), ("Pactuado?", "pactuado"), ("Motivo do Cancelamento", "justificativa"), ("Prazo", "data_pactuada"), ("Data Conclusão", "data_entrega"), ("Serviço/Ação", "servico"), ("Produto PTD", "produto"), ("Eixo", "eixo"), ("Nome", None)]


@query("column_roles", _sql(_ROLES, "name, role"))
def column_roles(spark, sf_dir):
    """Roles of delivery columns by their names."""
    return spark.createDataFrame([(n,) for n, _ in _ROLES], "name string").select("name", R.column_role(F.col("name")).alias("role"))


_BROKEN = [["", "texto acima", "x", ""], ["1", "um", "a;", ""], ["", "dois", "b", "z"], ["", "três", "", ""], ["2", "- item", "c", ""], ["", "outro", "", ""], ["", "mais", "d", ""], ["3", "fim", "e", "y"], ["", "ok", "", ""], ["", "", "", ""]]


@query("consolidate_cells", _sql([(0, "1", "texto acima um dois três", "x | a; | b", "z"), (4, "2", "- item | outro | mais", "c d", ""), (7, "3", "fim ok", "e", "y")], "row, a, b, c, d"))
def consolidate_cells(spark, sf_dir):
    """A table whose cells were broken over rows, joined again."""
    g = spark.createDataFrame([("x", 1, 0, ["ID", "B", "C", "D"], _BROKEN)], GRID)
    cell = lambda i: F.get("cells", F.lit(i))
    return R.consolidate(R.long_rows(g)).select("row", cell(0).alias("a"), cell(1).alias("b"), cell(2).alias("c"), cell(3).alias("d"))


@query("action_refs", _sql([("1, 2, 9", "1. Treinar | 2. Contratar"), ("ver item 1 do anexo", "ver item 1 do anexo"), ("", ""), ("7", "7")], "raw, resolved"))
def action_refs(spark, sf_dir):
    """Numbers resolved by the list of actions that a document's text gives."""
    lines = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(["capa", "Referencial para ações de tratamento", "1. Treinar", "2) Contratar", "3 - Medir", "4. Rever", "Anexo", "5. Nada"])], "doc string, page int, line int, text string")
    found = R.action_list(lines, r"[Rr]eferencial\s+para\s+a[çc][õo]es\s+de\s+tratamento").groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("number", "action"))).alias("m"))
    raw = spark.createDataFrame([("d", t) for t in ("1, 2, 9", "ver item 1 do anexo", "", "7")], "doc string, raw string")
    return raw.join(found, "doc").select("raw", R.resolve_refs(F.col("raw"), F.col("m")).alias("resolved"))


_AUDIT = [(1, "Probabilidade", "alto", "mitigar"), (2, "de de Ocor-", "raro", "x" * 40), (3, "alto", "muito baixo", "provável"), (4, "raro", "alto", "mitigar")]


@query("audit_categories", _sql([(1, "probability", "header_captured", None), (2, "probability", "fragment", None), (2, "impact", "column_shift", "probability"), (2, "treatment", "column_bleed", None), (3, "probability", "column_shift", "impact"), (3, "treatment", "column_shift", "probability")], "ord, field, category, fits"))
def audit_categories(spark, sf_dir):
    """Suspicious values of extracted risks by kind."""
    rows = spark.createDataFrame(_AUDIT, "ord int, probability string, impact string, treatment string")
    fields = {"probability": (PROBABILITY_SCALE, (IMPACT_SCALE,)), "impact": (IMPACT_SCALE, (PROBABILITY_SCALE,)), "treatment": (TREATMENTS, (PROBABILITY_SCALE, IMPACT_SCALE))}
    return R.audit(rows, fields, "ord").select("ord", "field", "category", "fits")


_AUDITED = {"probability": (PROBABILITY_SCALE, (IMPACT_SCALE,)), "impact": (IMPACT_SCALE, (PROBABILITY_SCALE,)), "treatment": (TREATMENTS, (PROBABILITY_SCALE, IMPACT_SCALE))}


@query("audit_flags", _sql([
    (1, True, "probabilidade: header capturado ('Probabilidade')", "low"),
    (2, True, "probabilidade: fragmento ('de de Ocor-'); impacto: column-shift (casa em 'probabilidade'); tratamento: bleed de coluna (40 chars)", "low"),
    (3, True, "probabilidade: column-shift (casa em 'impacto'); tratamento: column-shift (casa em 'probabilidade')", "low"), (4, False, None, "high"),
], "ord, needs_review, review_reason, confidence"))
def audit_flags(spark, sf_dir):
    """What an audit makes of the sample risks: review, reasons, confidence."""
    rows = spark.createDataFrame(_AUDIT, "ord int, probability string, impact string, treatment string")
    return R.flag_audited(rows, _AUDITED, "ord")[0].select("ord", "needs_review", "review_reason", "confidence")


_LINES = ["Portal de serviços do cidadão", "Integração ao Login Único", "Unificação de Canais Digitais", "jun/25", "abc", "Evolucao do Servico Dig", "dez-2025", "texto que nada diz a ninguém", "Outros", "x", "03/2026", "Balcão único de atendimento", "Adequação à LGPD"]


@query("text_line_deliveries", _sql([
    (1, "Portal de serviços do cidadão", "Integração ao Login Único", "Integração ao Login Único", "Unificação de Canais Digitais", "2025-06", 0.98, "high", False, None),
    (5, "", "Evolucao do Servico Dig", "Evolução do Serviço", "Serviços Digitais e Melhoria da Qualidade", "2025-12", 0.905, "medium", True, None),
    (8, "texto que nada diz a ninguém", "Outros", "Outros", "Projetos Especiais", "2026-03", 1.0, "high", True, "produto Outros"),
    (12, "Balcão único de atendimento", "Adequação à LGPD", "Adequação à LGPD", "Governança e Gestão de Dados", None, 1.0, "high", False, None),
], "line, service, original, product, axis, due, score, confidence, needs_review, review_reason"))
def text_line_deliveries(spark, sf_dir):
    """Deliveries read from lines of text: services before, dates behind, axes by the catalogue."""
    lines = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(_LINES)], "doc string, page int, line int, text string")
    return R.text_deliveries(lines, PRODUCT, AXIS).drop("doc", "page")


@pytest.mark.parametrize("name", CASES)
def test_case(spark, name):
    (want, columns), f = CASES[name]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in f(spark, None).collect()))) == sorted(map(repr, map(tuple, want)))


def test_swap_computes_its_rows_once(spark):
    """Rows that are dear to compute are kept, not computed for every use; null and blank cells are never exchanged."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def dear(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([("alto", "raro"), ("raro", "alto"), (None, "raro"), ("alto", "")], "p string, i string").coalesce(1).withColumn("p", dear("p"))
    got = [(r["p"], r["i"], r["swapped"]) for r in R.swap_columns(rows, "p", "i", PROBABILITY_SCALE, IMPACT_SCALE).collect()]
    assert sorted(got, key=repr) == sorted([("raro", "alto", True), ("raro", "alto", False), (None, "raro", False), ("alto", "", False)], key=repr)
    assert seen.value == 4
