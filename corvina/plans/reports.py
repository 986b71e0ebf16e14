"""Queries for queues, summaries and metrics over standardised deliveries and risks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.functions.vocabularies import AXES, IMPACT, PROBABILITY, PRODUCT, TREATMENT
from corvina.operators import reports, standardize
from corvina.operators.canonical import match_values
from corvina.plans.catalog import query, table
from corvina.plans.standard import _DELIVERIES, _RISKS, PRODUCTS_SEEN, _deliveries, _risks, _text, found

BOTH = f"""
WITH d AS ({_DELIVERIES} SELECT s.*, p_brand AS owner FROM s JOIN part ON p_partkey = ord),
r AS ({_RISKS} SELECT s.*, 'c' || (o_custkey % 50) AS owner, o_orderpriority || ' ' || o_orderstatus AS risk FROM s JOIN orders ON o_orderkey = ord)
"""
_LISTED = lambda scale: ", ".join(map(_text, scale))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised deliveries with their owners."""
    own = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("owner"), F.lit("pactuada").alias("table_kind"))
    return standardize.standardize_deliveries(_deliveries(spark, sf_dir).join(own, "ord"))


def risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised risks with their owners and texts."""
    own = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ord"), F.concat(F.lit("c"), F.col("o_custkey") % 50).alias("owner"), F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("risk"))
    return standardize.standardize_risks(_risks(spark, sf_dir).join(own, "ord"))


_ORIGINAL = "'P:' || coalesce(probability, '') || ' | I:' || coalesce(impact, '') || ' | T:' || coalesce(treatment, '')"
_CURRENT = "'P:' || probability_value || ' | I:' || impact_value || ' | T:' || treatment_value"


@query("export_queue", BOTH + f"""
SELECT owner, 'delivery' AS entry_type, 'produto / eixo' AS field, coalesce(product, '') AS original_value, product_value AS current_value, coalesce(axis, '') AS axis_original, axis_value, confidence, coalesce(review_reason, '') AS review_reason, service, 'pactuada' AS table_kind FROM d WHERE needs_review
UNION ALL SELECT owner, 'risk', 'probabilidade / impacto / tratamento', {_ORIGINAL}, {_CURRENT}, '', '', confidence, coalesce(review_reason, ''), substr(risk, 1, 100), '' FROM r WHERE needs_review""")
def export_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything under review with eleven columns in common."""
    return reports.export_queue(deliveries(spark, sf_dir), risks(spark, sf_dir))


_QUEUE = BOTH + f""", q AS (
SELECT CASE WHEN lower(review_reason) LIKE '%não reconhecido%' THEN CASE WHEN confidence = 'low' THEN 2 ELSE 3 END WHEN lower(review_reason) LIKE '%fuzzy%' THEN 4 WHEN lower(review_reason) LIKE '%cross-validation%' OR lower(review_reason) LIKE '%corrigido%' THEN 3 ELSE 4 END AS priority,
  owner, 'delivery' AS kind, coalesce(review_reason, 'needs review') AS issue, coalesce(product, '') AS original_value, product_value AS current_value, confidence FROM d WHERE needs_review
UNION ALL SELECT CASE WHEN lower(review_reason) LIKE '%não reconhecid%' THEN CASE WHEN confidence = 'low' THEN 2 ELSE 3 END ELSE 4 END, owner, 'risk', coalesce(review_reason, 'needs review'), {_ORIGINAL}, {_CURRENT}, confidence FROM r WHERE needs_review
UNION ALL SELECT 1, p_brand, 'error (plan)', 'no price', p_name, '', 'failed' FROM part WHERE p_retailprice < 905)"""


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = table(spark, sf_dir, "part").where("p_retailprice < 905").select(F.col("p_brand").alias("owner"), F.lit("plan").alias("kind"), F.lit("no price").alias("issue"), F.col("p_name").alias("value"))
    return reports.ranked_queue(deliveries(spark, sf_dir), risks(spark, sf_dir), errors)


@query("ranked_queue", _QUEUE + "SELECT * FROM q ORDER BY priority, owner, kind")
def ranked_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review queue with errors, the most urgent first."""
    return _queue(spark, sf_dir)


@query("queue_breakdown", _QUEUE + "SELECT 'priority' AS by, CAST(priority AS VARCHAR) AS value, count(*) AS n FROM q GROUP BY priority UNION ALL SELECT 'kind', kind, count(*) FROM q GROUP BY kind UNION ALL SELECT * FROM (SELECT 'owner', owner, count(*) AS n FROM q GROUP BY owner ORDER BY n DESC, owner LIMIT 10)")
def queue_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue by priority, by kind, and its ten largest owners."""
    return reports.queue_breakdown(_queue(spark, sf_dir))


_FIVE = [("d", "product", "service"), ("d", "axis", "service"), ("r", "probability", "risk"), ("r", "impact", "risk"), ("r", "treatment", "risk")]


@query("field_buckets", BOTH + ", f AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS original, owner, ord, {c} AS context, {f}_score AS score, {f}_method AS method, {f}_value AS match FROM {t} WHERE {f}_method IN ('fuzzy_low', 'unmatched') AND trim(coalesce({f}, '')) <> ''" for t, f, c in _FIVE) + """),
x AS (SELECT field, original, string_agg(owner || '/' || context, '; ' ORDER BY ord) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY field, original ORDER BY ord) AS n FROM f) WHERE n <= 5 GROUP BY ALL)
SELECT field, original, count(*) AS n, string_agg(DISTINCT owner, ',' ORDER BY owner) AS groups, CAST(min(score) AS DOUBLE) AS score_min, CAST(max(score) AS DOUBLE) AS score_max, arg_max(method, ord) AS method, arg_max(match, ord) AS match, x.examples, CAST(round(count(*) * (1 - min(score)), 6) AS DOUBLE) AS impact
FROM f JOIN x USING (field, original) GROUP BY field, original, x.examples""")
def field_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubtful values of all five fields in one list, the weightiest first."""
    d = reports.field_rows(deliveries(spark, sf_dir), ("product", "axis"), context="service")
    r = reports.field_rows(risks(spark, sf_dir), ("probability", "impact", "treatment"), context="risk")
    return reports.field_buckets(d.unionByName(r), ("fuzzy_low", "unmatched"))


@query("ascending_top", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 3")
def ascending_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent types, the least frequent of them first."""
    return reports.ascending_top(table(spark, sf_dir, "part"), "p_type", 3)


@query("quality_score", BOTH + ", e AS (SELECT confidence FROM d UNION ALL SELECT confidence FROM r) SELECT count(*) FILTER (confidence = 'high') AS high, count(*) AS total, round(count(*) FILTER (confidence = 'high') / count(*) * 100, 6) AS score FROM e")
def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of rows of high confidence in both tables."""
    return reports.quality_score(deliveries(spark, sf_dir), risks(spark, sf_dir))


_ON_SCALE = f"probability_value IN ({_LISTED(PROBABILITY)}) AND impact_value IN ({_LISTED(IMPACT)})"


@query("residuals_by_owner", BOTH + f"SELECT owner, count(*) AS n FROM r WHERE NOT ({_ON_SCALE}) GROUP BY owner")
def residuals_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risks off their scales by owner."""
    return reports.residuals_by_owner(risks(spark, sf_dir))


@query("document_counts", """
WITH o AS (SELECT CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS a, CASE WHEN s_acctbal > 5000 THEN s_name END AS b, CASE WHEN s_nationkey < 5 THEN s_nationkey END AS g FROM supplier)
SELECT count(*) AS owners, count(a) AS with_first, count(b) AS with_second, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS with_both, count(*) FILTER (a IS NULL AND b IS NULL) AS with_none, count(g) AS grouped, count(*) FILTER (coalesce(a, b) IS NOT NULL AND g IS NULL) AS holders, count(a) + count(b) AS documents FROM o""")
def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many suppliers have either of two documents."""
    s = table(spark, sf_dir, "supplier").select(F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("a"), F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("b"), F.when(F.col("s_nationkey") < 5, F.col("s_nationkey")).alias("g"))
    return reports.document_counts(s, "a", "b", "g")


@query("export_totals", "WITH l AS (SELECT source, count(*) AS n FROM documents GROUP BY source) SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS rows FROM l")
def export_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows of an export by source."""
    return reports.export_totals(table(spark, sf_dir, "documents").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("rows")))


@query("resolved_scores", f"WITH {found('pf', PRODUCTS_SEEN, PRODUCT)} SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 0.5 ELSE round(score, 3) END AS score, CASE WHEN p_partkey % 2 = 0 THEN 'fuzzy_low' ELSE CASE WHEN score <= 0 THEN 'unmatched' WHEN score >= 0.999 THEN 'exact' WHEN is_alias THEN 'alias' WHEN score >= 0.85 THEN 'fuzzy_high' WHEN score >= 0.7 THEN 'fuzzy_low' ELSE 'unmatched' END END AS method FROM part JOIN pf ON key = '{PRODUCT.terms[5]}'")
def resolved_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores that rows store, found anew for those that store none."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.lit(PRODUCT.terms[5]).alias("product"), F.when(F.col("p_partkey") % 2 == 0, 0.5).alias("score"), F.when(F.col("p_partkey") % 2 == 0, "fuzzy_low").alias("method"))
    got = match_values(p, "product", PRODUCT).select(F.col("product").alias("__p"), F.round("score", 3).alias("__s"), F.col("method").alias("__m"))
    score, method = reports.resolved_score("score", "method", F.col("__s"), F.col("__m"))
    return p.join(got, F.col("product") == F.col("__p")).select("p_partkey", score.alias("score"), method.alias("method"))


@query("delivery_metrics", BOTH + """
SELECT count(*) AS deliveries, count(DISTINCT owner) AS owners, count(DISTINCT product_value) AS products, count(*) FILTER (needs_review) AS needs_review, count(*) FILTER (contains(coalesce(review_reason, ''), 'cross-validation') OR contains(coalesce(review_reason, ''), 'eixo corrigido')) AS corrected_axes,
  count(*) FILTER (product_value = 'Outros') AS other, count(*) FILTER (product_value = 'Outros' AND length(trim(service)) < 10) AS fragments, count(DISTINCT owner) FILTER (product_value = 'Implementação do PPSI') AS ppsi_owners, count(DISTINCT owner) FILTER (product_value = 'Integração ao Login Único') AS login_owners FROM d""")
def delivery_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures on deliveries in one row."""
    return reports.delivery_metrics(deliveries(spark, sf_dir))


_CLASS = f"CASE WHEN trim(treatment_value) = '' THEN 'empty' WHEN len(p) = 0 OR len(list_filter(p, lambda y: y NOT IN ({_LISTED(TREATMENT)}))) > 0 THEN 'outside' WHEN trim(treatment_value) IN ({_LISTED(TREATMENT)}) THEN 'single' ELSE 'composite' END"


@query("risk_metrics", BOTH + f""", c AS (SELECT *, {_CLASS} AS kind FROM (SELECT *, list_filter(list_transform(string_split(treatment_value, ';'), lambda x: trim(x)), lambda x: x <> '') AS p FROM r))
SELECT count(*) AS risks, count(DISTINCT owner) AS owners, count(*) FILTER (probability_value IN ({_LISTED(PROBABILITY)})) AS probability_canonical, count(*) FILTER (impact_value IN ({_LISTED(IMPACT)})) AS impact_canonical, count(*) FILTER ({_ON_SCALE}) AS both_canonical,
  {', '.join(f"count(*) FILTER (kind = '{k}') AS treatment_{k}" for k in ('empty', 'single', 'composite', 'outside'))},
  count(*) FILTER (probability_value IN ({_LISTED(PROBABILITY[2:])}) AND impact_value IN ({_LISTED(IMPACT[3:])})) AS critical, count(*) FILTER (probability_value = {_text(PROBABILITY[-1])} AND impact_value = {_text(IMPACT[-1])}) AS gravest, count(*) FILTER (needs_review) AS needs_review FROM c""")
def risk_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures on risks in one row."""
    return reports.risk_metrics(risks(spark, sf_dir))


def _shape(col: str, scale: tuple[str, ...]) -> str:
    return "'{' || " + " || ',' || ".join(f"'\"{v}\":' || count(*) FILTER ({col} = {_text(v)})" for v in scale) + " || '}'"


@query("statistics_summary", BOTH + f""", o AS (SELECT owner, count(*) AS n FROM d GROUP BY owner), a AS (SELECT axis_value, count(*) AS n FROM d GROUP BY 1), t AS (SELECT product_value, count(*) AS n FROM d GROUP BY 1 ORDER BY n DESC, product_value LIMIT 5)
SELECT (SELECT CAST(sum(n) AS BIGINT) FROM o) AS deliveries, (SELECT count(*) FROM o) AS delivery_owners, (SELECT round(avg(n), 1) FROM o) AS mean, (SELECT CAST(floor(median(n)) AS BIGINT) FROM o) AS median, count(*) AS risks, count(DISTINCT owner) AS risk_owners, count(*) FILTER ({_ON_SCALE}) AS canonical_risks,
  {_shape('probability_value', PROBABILITY)} AS probability, {_shape('impact_value', IMPACT)} AS impact, {_shape('treatment_value', TREATMENT)} AS treatment,
  (SELECT '{{' || string_agg('"' || axis_value || '":' || n, ',' ORDER BY axis_value) || '}}' FROM a) AS axes, (SELECT string_agg(product_value, '; ' ORDER BY n DESC, product_value) FROM t) AS top_products FROM r""")
def statistics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, owners and distributions of both tables in one row."""
    return reports.summary(deliveries(spark, sf_dir), risks(spark, sf_dir))


_BODIES = "bodies AS (SELECT s_name, 'c' || (s_suppkey % 50) AS owner, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS directive, CASE WHEN s_acctbal > 5000 THEN s_name END AS delivery FROM supplier)"


@query("public_statistics", BOTH + f""", {_BODIES},
e AS (SELECT 'c' || (s_suppkey % 50) AS owner, CASE WHEN s_suppkey % 2 = 0 THEN 'directive' ELSE 'delivery' END AS document, CASE s_nationkey % 3 WHEN 0 THEN 'no_data' WHEN 1 THEN 'scan' ELSE 'timeout' END AS kind FROM supplier),
g AS (SELECT 'c' || (n_nationkey % 5) AS head, 'c' || n_nationkey AS member FROM nation UNION ALL SELECT DISTINCT 'Brand#11', p_brand FROM part WHERE p_brand LIKE 'Brand#1_'),
o AS (SELECT owner, count(*) AS n FROM d GROUP BY owner),
dh AS (SELECT owner FROM o UNION SELECT g.member FROM g WHERE head IN (SELECT head FROM g JOIN o ON o.owner = g.member)),
ro AS (SELECT DISTINCT owner FROM r), rh AS (SELECT owner FROM ro UNION SELECT g.member FROM g WHERE head IN (SELECT head FROM g JOIN ro ON ro.owner = g.member))
SELECT '2026-05-12' AS data_execucao, (SELECT count(*) FROM bodies) AS orgaos_total, (SELECT count(*) FROM d) AS entregas_total, (SELECT count(*) FROM dh) AS entregas_orgaos, (SELECT count(*) FROM r) AS riscos_total, (SELECT count(*) FROM rh) AS riscos_orgaos,
  (SELECT count(*) FROM r WHERE {_ON_SCALE}) AS riscos_canonicos, (SELECT count(directive) FROM bodies) AS pdfs_diretivo, (SELECT count(delivery) FROM bodies) AS pdfs_entregas, (SELECT count(directive) + count(delivery) FROM bodies) AS pdfs_total,
  (SELECT count(DISTINCT owner || '/' || document) FROM e WHERE kind <> 'timeout') AS pdfs_escaneados_pendentes,
  (SELECT '{{' || string_agg('"' || product_value || '":' || n, ',' ORDER BY n DESC, product_value) || '}}' FROM (SELECT product_value, count(*) AS n FROM d GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5)) AS top5_produtos,
  (SELECT '{{' || string_agg('"' || name || '":' || n, ',' ORDER BY i) || '}}' FROM (SELECT name, i, count(*) AS n FROM d JOIN (VALUES {", ".join(f"({i}, {_text(a)})" for i, a in enumerate(AXES))}) v(i, name) ON axis_value = name GROUP BY ALL)) AS entregas_por_eixo,
  (SELECT {_shape('probability_value', PROBABILITY)} FROM r) AS distribuicao_probabilidade, (SELECT {_shape('impact_value', IMPACT)} FROM r) AS distribuicao_impacto,
  (SELECT '{{' || string_agg('"' || t || '":' || n, ',' ORDER BY i) || '}}' FROM (SELECT t, i, count(*) AS n FROM (SELECT trim(unnest(string_split(treatment_value, ';'))) AS part FROM r) JOIN (VALUES {", ".join(f"({i}, {_text(t)})" for i, t in enumerate(TREATMENT))}) v(i, t) ON part = t GROUP BY ALL)) AS distribuicao_tratamento,
  (SELECT round(avg(n), 1) FROM o) AS media_entregas_por_orgao, (SELECT CAST(floor(median(n)) AS BIGINT) FROM o) AS mediana_entregas_por_orgao""")
def public_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of the public statistics in one row: bodies from suppliers, groups from nations and brands."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    owner = F.concat(F.lit("c"), k % 50)
    bodies = s.select(owner.alias("owner"), F.when(k % 3 > 0, F.col("s_name")).alias("directive"), F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("delivery"))
    errors = s.select(owner.alias("owner"), F.when(k % 2 == 0, "directive").otherwise("delivery").alias("document"), F.when(F.col("s_nationkey") % 3 == 0, "no_data").when(F.col("s_nationkey") % 3 == 1, "scan").otherwise("timeout").alias("kind"))
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("c"), F.col("n_nationkey") % 5).alias("head"), F.concat(F.lit("c"), "n_nationkey").alias("member"))
    brands = table(spark, sf_dir, "part").where(F.col("p_brand").rlike("^Brand#1.$")).select(F.lit("Brand#11").alias("head"), F.col("p_brand").alias("member")).distinct()
    return reports.statistics(deliveries(spark, sf_dir), risks(spark, sf_dir), bodies, errors, nations.unionByName(brands), "2026-05-12")
