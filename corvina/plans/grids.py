"""Queries for raw tables: kinds, roles, mending, extraction, audit, over tables that orders, parts and conversations carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.functions.vocabularies import AXIS, IMPACT_SCALE, PROBABILITY_SCALE, PRODUCT, PRODUCT_AXIS, TREATMENTS, Vocabulary
from corvina.operators import layout
from corvina.operators import tables as R
from corvina.operators.deliveries import catalogue_deliveries
from corvina.plans.catalog import query, table
from corvina.plans.scalars import NORM
from corvina.plans.standard import AXES_SEEN, PRODUCTS_SEEN, _text, found, pick, picked

_RISK = ["Risco", "Probabilidade", "Impacto", "Tratamento", "Ações"]
PROBABILITIES, IMPACTS, ACTIONS = ["raro", "pouco provável", "provável", "muito provável"], ["baixo", "médio", "alto", "muito alto"], ["mitigar", "aceitar", "transferir"]


def _cells(*values: Column | str) -> Column:
    return F.array(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in values])


def _table(page: int, tbl: int, header: Column, *rows: Column) -> Column:
    return F.struct(F.lit(page).alias("page"), F.lit(tbl).alias("tbl"), header.alias("header"), F.array(*rows).alias("rows"))


def risk_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each order, of seven kinds by its key: a table under names of risks, one that goes on over a page, one whose
    first risk stands in the header's place, owners, signatures, and tables of too many or too few columns."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    risk = lambda n: F.concat(F.lit(f"Falha {n} do cliente "), F.col("o_custkey"))
    one = lambda n: _cells(risk(n), pick(PROBABILITIES, k + n), pick(IMPACTS, F.floor(k / 4) + n), pick(ACTIONS, F.floor(k / 3) + n), F.col("o_orderpriority"))
    crossed = _cells(risk(2), pick(IMPACTS, k), pick(PROBABILITIES, F.floor(k / 4)), pick(ACTIONS, k), "2")
    named, plain = _cells(*_RISK), _cells("Col0", "Col1", "Col2", "Col3", "Col4")
    kinds = [
        [_table(1, 0, named, _cells("[1 raro a praticamente certo]", "", "", "", ""), one(0), one(1))],
        [_table(1, 0, named, one(0)), _table(2, 0, plain, named, crossed)],
        [_table(1, 0, one(0), one(1))],
        [_table(1, 0, _cells("Órgão", "Sigla", "CNPJ"), _cells(F.col("o_custkey"), "MX", "1"))],
        [_table(1, 0, _cells("Nome", "Cargo", "Assinatura"), _cells(F.col("o_custkey"), "B", ""))],
        [_table(1, 0, F.array_repeat(F.lit("c"), 9), F.array_repeat(F.lit("risco"), 9))],
        [_table(1, 0, plain, one(0), one(1))],
    ]
    out = F.array(*kinds[0])
    for i, t in enumerate(kinds[1:], 1):
        out = F.when(k % 7 == i, F.array(*t)).otherwise(out)
    return o.select(F.concat(F.lit("o"), k).alias("doc"), F.inline(out))


@query("table_classify", """
WITH t AS (SELECT * FROM (VALUES (0, 1, 'risk_table', false, false), (1, 1, 'risk_table', false, false), (1, 2, 'risk_table', false, false), (2, 1, 'unknown', true, false), (3, 1, 'organ_info', false, false),
  (4, 1, 'signature', false, false), (5, 1, 'unknown', false, false), (6, 1, 'unknown', false, true)) v(kind, page, directive, header_data, orphan))
SELECT 'o' || o_orderkey AS doc, page, 0 AS tbl, directive, 'unknown' AS delivery, header_data, orphan FROM orders JOIN t ON kind = o_orderkey % 7""")
def table_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of all tables."""
    return risk_grid(spark, sf_dir).select("doc", "page", "tbl", R.directive_kind().alias("directive"), R.delivery_kind().alias("delivery"), R.header_is_data().alias("header_data"), (R.is_orphan() & (R.directive_kind() != "risk_table")).alias("orphan"))


def _risk_row(n: int, page: int, row: int, kinds: str) -> str:
    return f"""SELECT 'o' || o_orderkey AS doc, {page} AS page, {row} AS row, 'Falha {n} do cliente ' || o_custkey AS risk, {picked(PROBABILITIES, f'o_orderkey + {n}')} AS probability, {picked(IMPACTS, f'o_orderkey // 4 + {n}')} AS impact,
  {picked(ACTIONS, f'o_orderkey // 3 + {n}')} AS treatment, o_orderpriority AS actions FROM orders WHERE o_orderkey % 7 IN ({kinds})"""


_RISKS = f"""WITH r AS ({_risk_row(0, 1, 1, '0')} UNION ALL {_risk_row(1, 1, 2, '0')} UNION ALL {_risk_row(0, 1, 0, '1, 6')} UNION ALL {_risk_row(0, 1, -1, '2')} UNION ALL {_risk_row(1, 1, 0, '2')} UNION ALL {_risk_row(1, 1, 1, '6')}
UNION ALL SELECT 'o' || o_orderkey, 2, 1, 'Falha 2 do cliente ' || o_custkey, {picked(IMPACTS, 'o_orderkey')}, {picked(PROBABILITIES, 'o_orderkey // 4')}, {picked(ACTIONS, 'o_orderkey')}, '2' FROM orders WHERE o_orderkey % 7 = 1)"""


@query("risk_extraction", _RISKS + " SELECT * FROM r")
def risk_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risks of all tables: under a header, going on over a page, and in a header's place."""
    return R.risk_rows(risk_grid(spark, sf_dir)).select("doc", "page", "row", "risk", "probability", "impact", "treatment", "actions")


_LEVELS = sorted({*PROBABILITIES, *IMPACTS})
_BARE = lambda v: Vocabulary(v.name, v.terms)


@query("risk_swap", _RISKS + f""", {found('pf', _LEVELS, PROBABILITY_SCALE)}, {found('jf', _LEVELS, IMPACT_SCALE)},
x AS (SELECT r.*, (a.score < 0.7 OR d.score < 0.7) AND b.score >= 0.85 AND c.score >= 0.85 AS swapped FROM r JOIN pf a ON a.key = probability JOIN jf b ON b.key = probability JOIN pf c ON c.key = impact JOIN jf d ON d.key = impact)
SELECT doc, risk, CASE WHEN swapped THEN impact ELSE probability END AS probability, CASE WHEN swapped THEN probability ELSE impact END AS impact, swapped FROM x""")
def risk_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and impact exchanged back where each fits the other's scale only."""
    rows = R.risk_rows(risk_grid(spark, sf_dir)).select("doc", "risk", "probability", "impact")
    return R.swap_columns(rows, "probability", "impact", PROBABILITY_SCALE, IMPACT_SCALE)


def delivery_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each part: a table under names, its next page without."""
    k = F.col("p_partkey")
    month = F.format_string("%02d/20%02d", (k % 12 + 1).cast("int"), (20 + k % 9).cast("int"))
    state = F.when(k % 3 == 0, "Concluído").when(k % 3 == 1, "cancelada").otherwise("")
    first = _table(1, 0, _cells("Serviço/Ação", "Produto", "Eixo", "Data Entrega", "Situação"), _cells(F.col("p_name"), F.col("p_type"), F.col("p_brand"), month, state), _cells("Produto", "Produto", "Eixo", "", ""))
    second = _table(2, 0, _cells("Balcão", F.col("p_type"), F.col("p_brand"), month, ""), _cells("nan", "B", "None", "dtentrega", "em andamento"))
    return table(spark, sf_dir, "part").select(F.concat(F.lit("p"), k).alias("doc"), F.inline(F.array(first, second)))


_MONTH = "(20 + p_partkey % 9 + 2000) || '-' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0')"


@query("delivery_extraction", f"""
SELECT 'p' || p_partkey AS doc, 1 AS page, 0 AS row, p_type AS product, p_name AS service, p_brand AS axis, CAST(NULL AS VARCHAR) AS due, {_MONTH} AS delivered, CASE p_partkey % 3 WHEN 1 THEN 'cancelada' ELSE 'concluida' END AS state FROM part
UNION ALL SELECT 'p' || p_partkey, 2, -1, p_type, 'Balcão', p_brand, NULL, {_MONTH}, 'concluida' FROM part
UNION ALL SELECT 'p' || p_partkey, 2, 0, 'B', '', '', NULL, NULL, 'pactuada' FROM part""".replace("(20 + p_partkey % 9 + 2000)", "CAST(2020 + p_partkey % 9 AS VARCHAR)"))
def delivery_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries under named columns, the second page going on without."""
    return R.table_deliveries(delivery_grid(spark, sf_dir)).select("doc", "page", "row", "product", "service", "axis", F.col("due").cast("string").alias("due"), "delivered", "state")


HEADERS = ["Situação", "STATUS", "Pactuado?", "entregue", "Motivo do Cancelamento", "Justificativa", "Prazo", "Data Pactuada", "DtPactu- ada", "Data Conclusão", "dt entrega", "Serviço/Ação", "Ação", "Produto PTD", " produto ", "Entrega", "Eixo", "Nome", "", None, "Área"]
_KEY = f"strip_accents(replace(lower({NORM.format('name')}), '- ', ''))"


@query("column_roles", f"""
WITH h AS (SELECT p_partkey, {picked(HEADERS, 'p_partkey')} || CASE WHEN p_partkey % 5 = 4 THEN ' ' || p_name ELSE '' END AS name FROM part), k AS (SELECT p_partkey, name, {_KEY} AS key, replace({_KEY}, ' ', '') AS tight FROM h)
SELECT p_partkey, name, CASE WHEN key IN ('status', 'situacao') THEN 'status' WHEN key IN ('pactuado', 'pactuado?', 'entregue', 'entregue?') THEN 'pactuado' WHEN key = 'justificativa' OR contains(key, 'motivo') AND contains(key, 'cancel') THEN 'justificativa'
  WHEN contains(key, 'servico') OR contains(key, 'acao') THEN 'servico' WHEN key IN ('produto', 'produto ptd', 'entrega') THEN 'produto' WHEN contains(key, 'eixo') THEN 'eixo'
  WHEN contains(tight, 'dtpactuada') OR contains(key, 'data pactuada') OR contains(key, 'prazo') THEN 'data_pactuada' WHEN contains(tight, 'dtentrega') OR contains(key, 'data entrega') OR contains(key, 'data conclusao') THEN 'data_entrega' END AS role FROM k""")
def column_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of delivery columns by their names, some with more words behind."""
    k = F.col("p_partkey")
    name = F.concat(pick(HEADERS, k), F.when(k % 5 == 4, F.concat(F.lit(" "), "p_name")).otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name")).withColumn("role", R.column_role(F.col("name")))


@query("consolidate_cells", """
WITH c AS (SELECT conv_id, role, length(text) AS n, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS turns FROM conversations)
SELECT conv_id, 3 * i AS row, CAST(turn AS VARCHAR) AS a, role || ' com ' || n AS b, CASE WHEN i % 2 = 0 THEN 'a; | b' ELSE 'a b' END AS c, 'z' AS d FROM c WHERE turns >= 3
UNION ALL SELECT conv_id, 3 * i + k, CASE k WHEN 0 THEN CAST(turn AS VARCHAR) ELSE '' END, CASE k WHEN 0 THEN role WHEN 1 THEN 'com' ELSE CAST(n AS VARCHAR) END, CASE k WHEN 0 THEN CASE WHEN i % 2 = 0 THEN 'a;' ELSE 'a' END WHEN 1 THEN 'b' ELSE '' END, CASE k WHEN 1 THEN 'z' ELSE '' END
  FROM c, (VALUES (0), (1), (2)) v(k) WHERE turns < 3""")
def consolidate_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each conversation, a turn's cells broken over three rows, joined again where ids show it."""
    c = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", "role", F.length("text").alias("n")).alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    three = lambda t, i: F.array(_cells(t["turn"], t["role"], F.when(i % 2 == 0, "a;").otherwise("a"), ""), _cells("", "com", "b", "z"), _cells("", t["n"], "", ""))
    g = c.select(F.col("conv_id").cast("string").alias("doc"), F.lit(1).alias("page"), F.lit(0).alias("tbl"), _cells("ID", "B", "C", "D").alias("header"), F.flatten(F.transform("ts", three)).alias("rows"))
    cell = lambda i: F.get("cells", F.lit(i))
    return R.consolidate(R.long_rows(g)).select(F.col("doc").cast("long").alias("conv_id"), F.col("row").cast("long").alias("row"), cell(0).alias("a"), cell(1).alias("b"), cell(2).alias("c"), cell(3).alias("d"))


@query("action_refs", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '1. Treinar ' || o_custkey || ' | 2. Contratar ' || o_orderstatus WHEN 1 THEN 'ver item 1 do anexo' WHEN 2 THEN '' ELSE '3. Medir' END AS resolved FROM orders""")
def action_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers resolved by the list of actions that each order's document gives."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    texts = _cells("capa", "1. antes da lista", "Referencial para ações de tratamento", F.concat(F.lit("1. Treinar "), "o_custkey"), F.concat(F.lit("2)  Contratar "), "o_orderstatus"), "3 - Medir", "4. Rever", "Anexo", "5. Nada")
    lines = o.select(k.cast("string").alias("doc"), F.lit(1).alias("page"), F.posexplode(texts).alias("line", "text"))
    actions = R.action_list(lines, r"[Rr]eferencial\s+para\s+a[çc][õo]es\s+de\s+tratamento").groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("number", "action"))).alias("m"))
    raw = o.select(k, k.cast("string").alias("doc"), pick(["1, 2, 9", "ver item 1 do anexo", "", "3;5"], k).alias("raw"))
    return raw.join(actions, "doc").select("o_orderkey", R.resolve_refs(F.col("raw"), F.col("m")).alias("resolved"))


_AUDITED = {"probability": (PROBABILITY_SCALE, (IMPACT_SCALE,)), "impact": (IMPACT_SCALE, (PROBABILITY_SCALE,)), "treatment": (TREATMENTS, (PROBABILITY_SCALE, IMPACT_SCALE))}
#: Texts of three fields, and what an audit says of each: kind and other field.
_SEEN = {
    "probability": {"raro": None, "Probabilidade": ("header_captured", None), "de de Ocor-": ("fragment", None), "alto": ("column_shift", "impact"), "": None},
    "impact": {"alto": None, "muito baixo": None, "raro": ("column_shift", "probability")},
    "treatment": {"mitigar": None, "x" * 40: ("column_bleed", None), "provável": ("column_shift", "probability"), "y" * 12: None},
}
_STEPS = {"probability": "o_orderkey", "impact": "o_orderkey // 5", "treatment": "o_orderkey // 2"}
_KINDS = " UNION ALL ".join(f"SELECT o_orderkey AS ord, '{f}' AS field, {i} AS place, v.category, v.fits, {picked(list(seen), _STEPS[f])} AS value FROM orders JOIN (VALUES {', '.join(f'({_text(t)}, {_text(k[0])}, {_text(k[1])})' for t, k in seen.items() if k)}) v(t, category, fits) ON v.t = {picked(list(seen), _STEPS[f])}" for i, (f, seen) in enumerate(_SEEN.items()))


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    steps = {"probability": k, "impact": F.floor(k / 5), "treatment": F.floor(k / 2)}
    return table(spark, sf_dir, "orders").select(k.alias("ord"), *[pick(list(seen), steps[f]).alias(f) for f, seen in _SEEN.items()])


@query("audit_categories", f"SELECT ord, field, category, fits FROM ({_KINDS})")
def audit_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspicious values of all orders' fields by kind."""
    return R.audit(_audited(spark, sf_dir), _AUDITED, "ord").select("ord", "field", "category", "fits")


_SAYS = "CASE category WHEN 'header_captured' THEN 'header capturado (''' || substr(value, 1, 30) || ''')' WHEN 'fragment' THEN 'fragmento (''' || substr(value, 1, 30) || ''')' WHEN 'column_bleed' THEN 'bleed de coluna (' || length(value) || ' chars)' ELSE 'column-shift (casa em ''' || CASE fits WHEN 'impact' THEN 'impacto' ELSE 'probabilidade' END || ''')' END"


@query("audit_flags", f"""
WITH f AS ({_KINDS}), w AS (SELECT ord, string_agg(CASE field WHEN 'probability' THEN 'probabilidade' WHEN 'impact' THEN 'impacto' ELSE 'tratamento' END || ': ' || {_SAYS}, '; ' ORDER BY place) AS why FROM f GROUP BY ord)
SELECT o_orderkey AS ord, why IS NOT NULL AS needs_review, why AS review_reason, CASE WHEN why IS NULL THEN 'high' ELSE 'low' END AS confidence FROM orders LEFT JOIN w ON ord = o_orderkey""")
def audit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an audit makes of all orders' fields: review, reasons, confidence."""
    return R.flag_audited(_audited(spark, sf_dir), _AUDITED, "ord")[0].select("ord", "needs_review", "review_reason", "confidence")


_PRODUCTS = [p for p in PRODUCTS_SEEN if p and p.strip()]
_OWN_AXIS = ", ".join(f"({_text(p)}, {_text(a)})" for p, a in PRODUCT_AXIS.items())
_NAMED = f"""WITH {found('pf', _PRODUCTS, PRODUCT)}, o AS (SELECT * FROM (VALUES {_OWN_AXIS}) v(product, own)),
p AS (SELECT part.*, {picked(_PRODUCTS, 'p_partkey')} AS raw, pf.match, pf.score, lower({NORM.format(picked(_PRODUCTS, 'p_partkey'))}) IN ('outros', 'outro', 'outros -', 'outros –') AS other FROM part JOIN pf ON pf.key = {NORM.format(picked(_PRODUCTS, 'p_partkey'))}),
n AS (SELECT p.*, CASE WHEN score >= 0.85 THEN match ELSE 'Outros' END AS product FROM p WHERE score >= 0.85 OR other)"""
_CONFIDENCE = "CASE WHEN score >= 0.95 THEN 'high' WHEN score >= 0.85 THEN 'medium' ELSE 'low' END"


@query("text_line_deliveries", _NAMED + f"""
SELECT 'p' || p_partkey AS doc, CAST(2 AS INT) AS line, 'Portal do cliente ' || p_name AS service, trim(raw) AS original, n.product, coalesce(own, '') AS axis, {_MONTH} AS due, round(score, 3) AS score, {_CONFIDENCE} AS confidence,
  score < 0.95 OR other AS needs_review, CASE WHEN other THEN 'produto Outros' END AS review_reason FROM n LEFT JOIN o ON o.product = n.product""".replace("(20 + p_partkey % 9 + 2000)", "CAST(2020 + p_partkey % 9 AS VARCHAR)"))
def text_line_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries read from lines of text, a document for each part: services before, dates behind, axes by the catalogue."""
    k = F.col("p_partkey")
    month = F.format_string("%02d/20%02d", (k % 12 + 1).cast("int"), (20 + k % 9).cast("int"))
    texts = F.array(F.lit("jun/25"), F.concat(F.lit("Portal do cliente "), "p_name"), pick(_PRODUCTS, k), F.lit("abc"), month)
    lines = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), k).alias("doc"), F.lit(1).alias("page"), F.posexplode(texts).alias("line", "text"))
    return R.text_deliveries(lines, PRODUCT, AXIS).drop("page")


def page_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each part, as positioned runs: a title, a table of five columns without names, its words set apart and its baselines
    uneven, a cell that goes on below, a row of two cells, and a line of text at the end."""
    k = F.col("p_partkey")
    at = lambda x, y, text: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"), (F.length(text) * 5.0).alias("width"), F.lit(10.0).alias("size"), text.alias("text"))
    words = F.split("p_name", " ")
    start = lambda i: F.length(F.array_join(F.slice(words, F.lit(1), i), " ")) * 5 + F.when(i > 0, 4).otherwise(0)
    service = F.transform(words, lambda w, i: at(F.lit(150.0) + start(i), F.lit(700.0) + (k + i) % 3, w))
    month = F.format_string("%02d/20%02d", (k % 12 + 1).cast("int"), (20 + k % 9).cast("int"))
    rest = F.array(
        at(F.lit(50.0), F.lit(800.0), F.col("p_brand")), at(F.lit(50.0), F.lit(700.0), F.lit("1")), at(F.lit(400.0), F.lit(701.0), pick(_PRODUCTS, k)), at(F.lit(900.0), F.lit(699.0), pick(AXES_SEEN[:6], k)), at(F.lit(1400.0), F.lit(700.0), month),
        at(F.lit(50.0), F.lit(672.0), F.lit("2")), at(F.lit(150.0), F.lit(672.0), F.lit("App")), at(F.lit(400.0), F.lit(672.0), F.lit("Adequação à LGPD")), at(F.lit(150.0), F.lit(661.0), F.col("p_type")),
        at(F.lit(50.0), F.lit(640.0), F.lit("3")), at(F.lit(150.0), F.lit(640.0), F.lit("Sem produto")), at(F.lit(50.0), F.lit(560.0), F.lit("fim")),
    )
    return table(spark, sf_dir, "part").select(F.concat(F.lit("p"), k).alias("doc"), F.lit(1).alias("page"), F.inline(F.concat(rest, service)))


@query("layout_lines", f"""
SELECT 'p' || p_partkey AS doc, v.line, CASE v.line WHEN 1 THEN p_brand WHEN 2 THEN '1 ' || p_name || ' ' || regexp_replace(trim({picked(_PRODUCTS, 'p_partkey')}), ' +', ' ', 'g') || ' ' || trim({picked(AXES_SEEN[:6], 'p_partkey')}) || ' ' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') || '/' || CAST(2020 + p_partkey % 9 AS VARCHAR)
  WHEN 3 THEN '2 App Adequação à LGPD' WHEN 4 THEN p_type WHEN 5 THEN '3 Sem produto' ELSE 'fim' END AS text FROM part, (VALUES (1), (2), (3), (4), (5), (6)) v(line)""")
def layout_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all pages from their runs."""
    lines = layout.lines(page_runs(spark, sf_dir))
    return lines.select("doc", F.col("line").cast("int").alias("line"), "text")


@query("layout_tables", f"""
SELECT 'p' || p_partkey AS doc, 0 AS tbl, '1|' || p_name || '|' || regexp_replace(trim({picked(_PRODUCTS, 'p_partkey')}), ' +', ' ', 'g') || '|' || trim({picked(AXES_SEEN[:6], 'p_partkey')}) || '|' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') || '/' || CAST(2020 + p_partkey % 9 AS VARCHAR) AS header,
  '2|App ' || p_type || '|Adequação à LGPD||; 3|Sem produto|||' AS rows FROM part""")
def layout_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of all pages from their runs: words joined to cells, cells to columns, the broken cell joined again."""
    g = layout.tables(page_runs(spark, sf_dir))
    return g.select("doc", "tbl", F.array_join("header", "|").alias("header"), F.array_join(F.transform("rows", lambda r: F.array_join(r, "|")), "; ").alias("rows"))


@query("recovered_deliveries", """
SELECT 'p' || p_partkey AS doc, 0 AS row, 'App ' || p_type AS service, 'Adequação à LGPD' AS product, 'Governança e Gestão de Dados' AS axis, 'high' AS confidence, false AS needs_review FROM part""")
def recovered_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of the pages' tables, whose columns only their values tell."""
    got = catalogue_deliveries(layout.tables(page_runs(spark, sf_dir)))
    return got.select("doc", "row", "service", "product", "axis", "confidence", "needs_review")


@query("catalogue_deliveries", _NAMED + f""", s AS (SELECT n.*, n.p_partkey % 3 AS kind, coalesce(own, '') AS axis FROM n LEFT JOIN o ON o.product = n.product)
SELECT 'p' || p_partkey AS doc, CAST(CASE kind WHEN 1 THEN 1 ELSE 0 END AS INT) AS row, 1 AS page, p_name AS service, regexp_replace(trim(raw), ' +', ' ', 'g') AS original, product, axis, CASE WHEN kind <> 2 THEN '2025-12' END AS due, round(score, 3) AS score, {_CONFIDENCE} AS confidence,
  score < 0.95 OR other AS needs_review, CASE WHEN other THEN 'produto Outros' WHEN score < 0.95 THEN 'fuzzy=' || printf('%.2f', score) END AS review_reason FROM s
UNION ALL SELECT 'p' || p_partkey, -1, 2, p_type, regexp_replace(trim(raw), ' +', ' ', 'g'), product, axis, NULL, round(score, 3), 'medium', true, 'recuperado de header multi-página' FROM s WHERE kind = 0
UNION ALL SELECT 'p' || p_partkey, 0, 2, p_brand, 'Adequação à LGPD', 'Adequação à LGPD', 'Governança e Gestão de Dados', '2026-03', 1.0, 'high', false, NULL FROM part WHERE p_partkey % 3 = 0""")
def catalogue_deliveries_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each part: columns by names, by names in the first row, or by values; the next page of the first kind begins with a delivery."""
    k = F.col("p_partkey")
    product = pick(_PRODUCTS, k)
    own = _cells(F.col("p_name"), product, "", "12/2025")
    named = [_table(1, 0, _cells("Serviço", "Produto", "Eixo", "Prazo"), own), _table(2, 0, _cells(F.col("p_type"), product, "Canais", ""), _cells(F.col("p_brand"), "Adequação à LGPD", "", "03/2026"))]
    first = [_table(1, 0, _cells("1", "2", "3", "4"), _cells("Serviço", "Produto", "Eixo", "Prazo"), own)]
    value = [_table(1, 0, _cells("x", "y", "z"), _cells(F.col("p_name"), product, ""))]
    tables = F.when(k % 3 == 0, F.array(*named)).when(k % 3 == 1, F.array(*first)).otherwise(F.array(*value))
    got = catalogue_deliveries(table(spark, sf_dir, "part").select(F.concat(F.lit("p"), k).alias("doc"), F.inline(tables)))
    return got.select("doc", "row", "page", "service", "original", "product", "axis", "due", "score", "confidence", "needs_review", "review_reason")


@query("window_counts", "SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and type: the rows that the streaming counterpart makes final."""
    from corvina.streaming.refresh import window_counts as counts

    w = counts(table(spark, sf_dir, "events"), "ts", "1 day", "event_type")
    return w.select(F.col("start").cast("timestamp_ntz").alias("day"), "event_type", "n")
