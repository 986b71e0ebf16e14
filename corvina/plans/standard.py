"""Queries for standardised deliveries and risks, over parts and orders that carry spellings of the fields."""

from __future__ import annotations

import difflib
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.functions.vocabularies import AXES, AXIS, GROUP_ROWS, IMPACT_SCALE, PROBABILITY_SCALE, PRODUCT, PRODUCT_AXIS, TREATMENTS, Vocabulary
from corvina.operators import groups, standardize
from corvina.plans.catalog import query, table
from corvina.plans.scalars import NORM

PRODUCTS_SEEN = [*PRODUCT.terms[::5], "Integração ao Login Unico", "INTEGRACAO AO LOGIN UNICO GOV.BR", "  Adequação à   LGPD ", "Elaboração da POSIC", "digitalização de serviço", "Outros", "Integração ao Pagtesour", "Abertura da base de dado", "Migração de Portal", "Algo totalmente fora", "", None]
AXES_SEEN = [*AXES, "Governo Aberto e Transparencia", "governaça e gestão de dados", "Governança de Dados", "Canais", "Projetos", None]
PROBABILITY_SEEN = [*PROBABILITY_SCALE.terms, "Media", "Muito  Provavel", "praticamente certos", "provavl", "xpto sem sentido", "", None]
IMPACT_SEEN = [*IMPACT_SCALE.terms, "1-Alto", "CRITICO", "médioo", "muito alt", "nenhum deles", ""]
TREATMENT_SEEN = [*TREATMENTS.terms, "mitigar; transferir", "Mitigar/Transferir", "transferir/compartilhar", "Aceitar, Evitar", "mitiga", "mitigr", "nada; mitigar", ";", "", None]


def pick(seen: list[str | None], at: Column) -> Column:
    """The spelling at a number."""
    return F.get(F.array(*[F.lit(x).cast("string") for x in seen]), F.pmod(at, F.lit(len(seen))).cast("int"))


def _text(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def picked(seen: list[str | None], at: str) -> str:
    """The spelling at a number, in SQL."""
    return f"([{', '.join(map(_text, seen))}])[CAST(1 + ({at}) % {len(seen)} AS INT)]"


def _fold(t: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", " ".join(t.split()).lower()) if not unicodedata.combining(c))


def _ratio_rows(texts: list[str], vocab: Vocabulary) -> str:
    """SQL rows (key, match, score): the first term of the largest ratio to each folded text."""
    rows = []
    for t in dict.fromkeys(map(_fold, texts)):
        scores = [difflib.SequenceMatcher(None, t, _fold(x)).ratio() for x in vocab.terms]
        best = max(range(len(scores)), key=lambda i: (scores[i], -i))
        rows.append(f"({_text(t)}, {_text(vocab.terms[best] if scores[best] else '')}, CAST({scores[best]!r} AS DOUBLE))")
    return ", ".join(rows)


def found(name: str, texts: list[str | None], vocab: Vocabulary) -> str:
    """SQL tables up to ``name`` (key, match, score, is_alias), by a normalised text: aliases first, then terms, then ratios."""
    full = [t for t in texts if t and t.strip()]
    aliases = ", ".join(f"({i}, {_text(k)}, {_text(v)})" for i, (k, v) in enumerate(vocab.aliases.items()))
    terms = ", ".join(f"({i}, {_text(t)})" for i, t in enumerate(vocab.terms))
    return f"""
{name}_n AS (SELECT DISTINCT {NORM.format('t')} AS key FROM (VALUES {', '.join(f'({_text(t)})' for t in texts)}) v(t)),
{name}_a AS (SELECT key, arg_min(target, r) AS target, arg_min(s, r) AS s FROM (
  SELECT n.key, a.target, 2 * a.i AS r, CAST({vocab.literal} AS DOUBLE) AS s FROM {name}_n n JOIN (VALUES {aliases}) a(i, k, target) ON lower(a.k) = lower(n.key)
  UNION ALL SELECT n.key, a.target, 2 * a.i + 1, CAST({vocab.folded} AS DOUBLE) FROM {name}_n n JOIN (VALUES {aliases}) a(i, k, target) ON strip_accents(lower(a.k)) = strip_accents(lower(n.key))) GROUP BY key),
{name}_t AS (SELECT n.key, arg_min(t.term, t.i) AS term FROM {name}_n n JOIN (VALUES {terms}) t(i, term) ON strip_accents(lower(t.term)) = strip_accents(lower(n.key)) GROUP BY n.key),
{name}_f AS (SELECT * FROM (VALUES {_ratio_rows(full, vocab)}) f(k, match, score)),
{name} AS (SELECT n.key, coalesce(a.target, t.term, f.match, '') AS match, coalesce(a.s, CASE WHEN t.term IS NOT NULL THEN 1.0 END, f.score, 0.0) AS score, a.target IS NOT NULL AS is_alias
  FROM {name}_n n LEFT JOIN {name}_a a USING (key) LEFT JOIN {name}_t t USING (key) LEFT JOIN {name}_f f ON f.k = strip_accents(lower(n.key)))"""


METHOD = "CASE WHEN {0}score <= 0 THEN 'unmatched' WHEN {0}score >= 0.999 THEN 'exact' WHEN {0}is_alias THEN 'alias' WHEN {0}score >= 0.85 THEN 'fuzzy_high' WHEN {0}score >= 0.7 THEN 'fuzzy_low' ELSE 'unmatched' END"
_DELIVERIES = f"""
WITH d AS (SELECT p_partkey AS ord, {picked(PRODUCTS_SEEN, 'p_partkey')} AS product, {picked(AXES_SEEN, 'p_partkey // 7')} AS axis, CASE WHEN p_partkey % 3 = 0 THEN ' ' || substr(p_name, 1, 4) ELSE p_name END AS service FROM part),
{found('pf', PRODUCTS_SEEN, PRODUCT)},
{found('af', AXES_SEEN, AXIS)},
o AS (SELECT * FROM (VALUES {', '.join(f'({_text(p)}, {_text(a)})' for p, a in PRODUCT_AXIS.items())}) v(product, own)),
k AS (SELECT *, {NORM.format('product')} AS pk, {NORM.format('axis')} AS ak FROM d),
x AS (SELECT k.*, CASE WHEN pf.score >= 0.7 THEN pf.match ELSE 'UNMATCHED' END AS pv, pf.score AS ps, {METHOD.format('pf.')} AS pm,
  CASE WHEN af.score >= 0.7 THEN af.match ELSE coalesce(first_value(axis) OVER (PARTITION BY ak ORDER BY ord), '') END AS av, af.score AS sa, {METHOD.format('af.')} AS am, ord = min(ord) OVER (PARTITION BY pk) AS fresh
  FROM k JOIN pf ON pf.key = pk JOIN af ON af.key = ak),
y AS (SELECT x.*, own, CASE WHEN fresh AND ps < 0.7 THEN 'produto não reconhecido (melhor score: ' || printf('%.2f', ps) || ')' WHEN fresh AND ps < 0.85 THEN 'fuzzy match baixo (' || printf('%.2f', ps) || ')' END AS why FROM x LEFT JOIN o ON o.product = pv),
s AS (SELECT ord, product, axis, service, pv AS product_value, round(ps, 3) AS product_score, pm AS product_method, coalesce(own, av) AS axis_value, round(sa, 3) AS axis_score, am AS axis_method,
  why IS NOT NULL OR coalesce(own <> av, false) AS needs_review,
  CASE WHEN own <> av AND why IS NULL THEN 'eixo corrigido por cross-validation: ''' || av || ''' → ''' || own || '''' WHEN own <> av THEN why || '; eixo corrigido: ''' || av || ''' → ''' || own || '''' ELSE why END AS review_reason,
  CASE WHEN fresh AND ps < 0.7 THEN 'low' WHEN fresh AND ps < 0.85 THEN 'medium' ELSE 'high' END AS confidence FROM y)"""


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("ord"), pick(PRODUCTS_SEEN, k).alias("product"), pick(AXES_SEEN, F.floor(k / 7)).alias("axis"), F.when(k % 3 == 0, F.concat(F.lit(" "), F.substring("p_name", 1, 4))).otherwise(F.col("p_name")).alias("service"))


@query("standardize_deliveries", _DELIVERIES + "SELECT * FROM s")
def standardize_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries with canonical products and axes, what is doubtful about them, and axes corrected by products."""
    return standardize.standardize_deliveries(_deliveries(spark, sf_dir))


@query("delivery_mappings", _DELIVERIES + """
SELECT 'product' AS type, pk AS original, any_value(pv) AS normalized, any_value(ps) AS score, count(*) AS n FROM x GROUP BY pk
UNION ALL SELECT 'axis', ak, any_value(av), any_value(sa), count(*) FROM x GROUP BY ak""")
def delivery_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every spelling of a product or axis."""
    return standardize.delivery_mappings(_deliveries(spark, sf_dir))


@query("fragments_by_owner", _DELIVERIES + "SELECT p_brand AS owner, count(*) AS n FROM s JOIN part ON p_partkey = ord WHERE product_value = 'Outros' AND length(trim(service)) < 10 GROUP BY p_brand")
def fragments_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken cells that are dropped, by brand."""
    done = standardize.standardize_deliveries(_deliveries(spark, sf_dir))
    own = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("owner"))
    return standardize.fragments_by_owner(done.join(own, "ord"), "owner")


_PARTS = sorted({p.strip() for t in TREATMENT_SEEN if t for p in t.replace("/", ";").replace(",", ";").split(";") if p.strip()})
_RISKS = f"""
WITH d AS (SELECT o_orderkey AS ord, {picked(PROBABILITY_SEEN, 'o_orderkey')} AS probability, {picked(IMPACT_SEEN, 'o_orderkey // 5')} AS impact, {picked(TREATMENT_SEEN, 'o_orderkey // 3')} AS treatment FROM orders),
{found('pf', PROBABILITY_SEEN, PROBABILITY_SCALE)},
{found('jf', IMPACT_SEEN, IMPACT_SCALE)},
{found('tf', _PARTS, TREATMENTS)},
tk AS (SELECT DISTINCT {NORM.format('t')} AS key FROM (VALUES {', '.join(f'({_text(t)})' for t in TREATMENT_SEEN)}) v(t)),
tp AS (SELECT key, unnest(string_split_regex(key, '\\s*[;,/]\\s*')) AS part, generate_subscripts(string_split_regex(key, '\\s*[;,/]\\s*'), 1) AS i FROM tk),
tj AS (SELECT tp.key, string_agg(CASE WHEN score >= 0.7 THEN match ELSE part END, '; ' ORDER BY i) AS value, min(score) AS worst, string_agg(CASE WHEN score < 0.7 THEN 'tratamento ''' || part || ''' não reconhecido (score: ' || printf('%.2f', score) || ')' END, '; ' ORDER BY i) AS why FROM tp JOIN tf ON tf.key = part WHERE part <> '' GROUP BY tp.key),
t AS (SELECT tk.key, coalesce(value, tk.key) AS value, CASE WHEN tk.key = '' THEN 0.0 ELSE coalesce(worst, 1.0) END AS score, why, strip_accents(lower(tk.key)) IN ({', '.join(_text(k.lower()) for k in TREATMENTS.aliases)}) AS is_alias FROM tk LEFT JOIN tj USING (key)),
k AS (SELECT *, {NORM.format('probability')} AS pk, {NORM.format('impact')} AS ik, {NORM.format('treatment')} AS tkey FROM d),
x AS (SELECT k.*, CASE WHEN pf.score >= 0.7 THEN pf.match ELSE coalesce(first_value(probability) OVER (PARTITION BY pk ORDER BY ord), '') END AS pv, pf.score AS ps, {METHOD.format('pf.')} AS pm,
  CASE WHEN jf.score >= 0.7 THEN jf.match ELSE coalesce(first_value(impact) OVER (PARTITION BY ik ORDER BY ord), '') END AS iv, jf.score AS si, {METHOD.format('jf.')} AS im, t.value AS tv, t.score AS ts, {METHOD.format('t.')} AS tm, least(pf.score, jf.score, t.score) AS worst,
  CASE WHEN ord <> min(ord) OVER (PARTITION BY pk) THEN NULL WHEN pf.score < 0.7 THEN 'probabilidade não reconhecida (score: ' || printf('%.2f', pf.score) || ')' WHEN pf.score < 0.85 THEN 'probabilidade fuzzy (' || printf('%.2f', pf.score) || ')' END AS w1,
  CASE WHEN ord <> min(ord) OVER (PARTITION BY ik) THEN NULL WHEN jf.score < 0.7 THEN 'impacto não reconhecido (score: ' || printf('%.2f', jf.score) || ')' WHEN jf.score < 0.85 THEN 'impacto fuzzy (' || printf('%.2f', jf.score) || ')' END AS w2,
  CASE WHEN ord = min(ord) OVER (PARTITION BY tkey) THEN t.why END AS w3, CASE WHEN contains(t.value, '; ') THEN 'tratamento múltiplo/composto (''' || substr(t.value, 1, 40) || ''')' END AS w4
  FROM k JOIN pf ON pf.key = pk JOIN jf ON jf.key = ik JOIN t ON t.key = tkey),
s AS (SELECT ord, probability, impact, treatment, pv AS probability_value, round(ps, 3) AS probability_score, pm AS probability_method, iv AS impact_value, round(si, 3) AS impact_score, im AS impact_method, tv AS treatment_value, round(ts, 3) AS treatment_score, tm AS treatment_method,
  worst < 0.85 OR coalesce(w1, w2, w3, w4) IS NOT NULL AS needs_review, nullif(concat_ws('; ', w1, w2, w3, w4), '') AS review_reason, CASE WHEN worst < 0.7 THEN 'low' WHEN worst < 0.85 THEN 'medium' ELSE 'high' END AS confidence FROM x)"""


def _risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("ord"), pick(PROBABILITY_SEEN, k).alias("probability"), pick(IMPACT_SEEN, F.floor(k / 5)).alias("impact"), pick(TREATMENT_SEEN, F.floor(k / 3)).alias("treatment"))


@query("standardize_risks", _RISKS + "SELECT * FROM s")
def standardize_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risks on canonical scales, with treatments of several parts, reasons for review and confidence."""
    return standardize.standardize_risks(_risks(spark, sf_dir))


@query("risk_match_stats", _RISKS + """, m AS (SELECT 'probability' AS type, ps AS score FROM x UNION ALL SELECT 'impact', si FROM x UNION ALL SELECT 'treatment', ts FROM x)
SELECT type, count(*) FILTER (score = 1.0) AS exact, count(*) FILTER (score >= 0.7 AND score < 1.0) AS fuzzy, count(*) FILTER (score < 0.7) AS unmatched FROM m GROUP BY type""")
def risk_match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the three fields of all risks match their scales."""
    return standardize.match_stats(standardize.risk_mappings(_risks(spark, sf_dir)))


_HEADS = sorted({h for h, _ in GROUP_ROWS})


@query("named_groups", f"""
WITH g AS (SELECT * FROM (VALUES {', '.join(f"('{h}', '{m}')" for h, m in GROUP_ROWS)}) v(head, member)),
e AS (SELECT {picked([*_HEADS, 'X'], 's_suppkey')} AS entity, max(s_name) AS url FROM supplier GROUP BY 1)
SELECT coalesce(g.member, entity) AS entity, url, CASE WHEN head <> member THEN head END AS inherited_from FROM e LEFT JOIN g ON head = entity""")
def named_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every body of the known groups with the plan that its head among the suppliers publishes; others keep their own."""
    g = spark.createDataFrame(GROUP_ROWS, "head string, member string")
    heads = table(spark, sf_dir, "supplier").select(pick([*_HEADS, "X"], F.col("s_suppkey")).alias("entity"), "s_name").groupBy("entity").agg(F.max("s_name").alias("url"))
    return groups.expand_members(heads, g, "entity", "url")
