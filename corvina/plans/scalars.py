"""Queries for text, date and matching scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.functions import dates, numbers, text
from corvina.functions.vocabularies import IMPACT, IMPACT_ALIASES, IMPACT_SCALE, PROBABILITY, PROBABILITY_ALIASES, PROBABILITY_SCALE, TREATMENT, TREATMENT_ALIASES, TREATMENTS, Vocabulary
from corvina.operators import canonical
from corvina.plans.catalog import query, table

PRIORITY = Vocabulary("priority", ("URGENT", "HIGH", "MEDIUM", "LOW", "UNSPECIFIED"), {"1-URGENT": "URGENT", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM", "4-NOT SPECIFIED": "UNSPECIFIED", "5-LOW": "LOW"})
NORM = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce({0}, ''), '\p{{Cf}}', '', 'g'), '[\s\x{{0B}}\x{{1C}}-\x{{1F}}\x{{85}}\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g'), '^[A-Za-z0-9]{{1,3}}\s*[).\-]\s+', '')"""
LATIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def values(rows: list[str], name: str = "t") -> str:
    """A SQL table of one text column, with its place."""
    return ", ".join(f"({i}, {'NULL' if r is None else chr(39) + r.replace(chr(39), chr(39) * 2) + chr(39)})" for i, r in enumerate(rows))


@query("canon_priority_counts", """
WITH s AS (SELECT * FROM (VALUES (0,'URGENT'),(1,'HIGH'),(2,'MEDIUM'),(3,'LOW'),(4,'UNSPECIFIED')) t(pos, term)),
m AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '4-NOT SPECIFIED' THEN 'UNSPECIFIED' WHEN '5-LOW' THEN 'LOW' END AS term FROM orders)
SELECT s.pos, s.term, count(m.term) AS n FROM s LEFT JOIN m USING (term) GROUP BY s.pos, s.term""")
def canon_priority_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per canonical priority level, levels without orders included."""
    from corvina.operators.analytics import scale_counts

    orders = canonical.canonicalize(table(spark, sf_dir, "orders").select("o_orderpriority"), "o_orderpriority", PRIORITY)
    return scale_counts(orders, "priority_value", PRIORITY.terms)


@query("match_method_buckets", """
WITH m AS (SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'alias' ELSE 'alias' END AS method FROM orders UNION ALL SELECT 'exact' FROM customer)
SELECT method, count(*) AS n FROM m GROUP BY method""")
def match_method_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per way of matching: priorities by alias, segments exactly."""
    segments = Vocabulary("segment", ("Automobile", "Building", "Furniture", "Machinery", "Household"))
    a = canonical.canonicalize(table(spark, sf_dir, "orders").select("o_orderpriority"), "o_orderpriority", PRIORITY).select(F.col("priority_method").alias("method"))
    b = canonical.canonicalize(table(spark, sf_dir, "customer").select("c_mktsegment"), "c_mktsegment", segments).select(F.col("segment_method").alias("method"))
    return a.unionByName(b).groupBy("method").agg(F.count("*").alias("n"))


_FUZZY = [(t, t[: len(t) - k]) for t in ("STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL") for k in (1, 2)]


def _ratios() -> str:
    import difflib

    terms = sorted({t for t, _ in _FUZZY})
    out = []
    for t, cut in _FUZZY:
        r = [difflib.SequenceMatcher(None, cut.lower(), x.lower()).ratio() for x in terms]
        best = max(range(len(terms)), key=lambda i: (r[i], -i))
        s = round(r[best], 3)
        out.append(f"('{t}', '{cut}', '{terms[best]}', CAST({s} AS DOUBLE), '{'fuzzy_high' if r[best] >= 0.85 else 'fuzzy_low' if r[best] >= 0.7 else 'unmatched'}')")
    return ", ".join(out)


@query("canon_fuzzy_top1", f"""
WITH r AS (SELECT * FROM (VALUES {_ratios()}) t(p_type, cut, term_value, term_score, term_method))
SELECT cut, term_value, term_score, term_method, count(*) AS n FROM part JOIN r USING (p_type) GROUP BY ALL""")
def canon_fuzzy_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types cut short by one or two letters and found again by similarity."""
    vocab = Vocabulary("term", tuple(sorted({t for t, _ in _FUZZY})))
    cut = table(spark, sf_dir, "part").select(F.explode(F.array(*[F.expr(f"substring(p_type, 1, length(p_type) - {k})") for k in (1, 2)])).alias("cut"))
    return canonical.canonicalize(cut, "cut", vocab).groupBy("cut", "term_value", "term_score", "term_method").agg(F.count("*").alias("n"))


_SCALES = [("probability", PROBABILITY, PROBABILITY_ALIASES, PROBABILITY_SCALE), ("impact", IMPACT, IMPACT_ALIASES, IMPACT_SCALE), ("treatment", TREATMENT, TREATMENT_ALIASES, TREATMENTS)]


_SPELLED = {n: [*aliases, *(t.upper() for t in terms)] for n, terms, aliases, _ in _SCALES}


def _levels_sql(n: str, terms: tuple[str, ...], aliases: dict[str, str]) -> str:
    rows = ", ".join(f"('{k}', '{v}', CAST({s} AS DOUBLE), '{m}')" for k, v, s, m in [*((k, v, 0.95, "alias") for k, v in aliases.items()), *((t.upper(), t, 1.0, "exact") for t in terms if t.lower() not in {k.lower() for k in aliases})])
    seen = "[" + ", ".join(f"'{t}'" for t in _SPELLED[n]) + "]"
    return f"SELECT o_orderkey, '{n}' AS field, k AS raw, v AS value, s AS score, m AS method FROM orders JOIN (VALUES {rows}) l(k, v, s, m) ON k = ({seen})[CAST(1 + o_orderkey % {len(_SPELLED[n])} AS INT)]"


@query("scale_levels", " UNION ALL ".join(_levels_sql(n, terms, aliases) for n, terms, aliases, _ in _SCALES))
def scale_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aliases and terms of the three risk scales as orders carry them, matched against their scales at once."""
    k = F.col("o_orderkey")
    seen = [F.struct(F.lit(n).alias("field"), F.get(F.array(*map(F.lit, texts)), F.pmod(k, F.lit(len(texts))).cast("int")).alias("raw")) for n, texts in _SPELLED.items()]
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.array(*seen)).alias("x")).select("o_orderkey", "x.*")
    found = canonical.match_fields(rows.select("field", "raw").distinct(), "raw", {n: vocab for n, _, _, vocab in _SCALES})
    return rows.join(found, ["field", "raw"]).select("o_orderkey", "field", "raw", F.col("match").alias("value"), "score", "method")


_NORM = ["A) Evitar", "12) Item", "II. Probabilidade", "iv) opção", "abcd) X", "hello\t\n world", "a​b­", "x  y", "TI - falha", "mar. 2025", "", None]


@query("norm_text_scalars", f"""
WITH t AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'l' || i, t FROM (VALUES {values(_NORM)}) v(i, t))
SELECT id, md5({NORM.format('text')}) AS norm, length({NORM.format('text')}) AS chars FROM t""")
def norm_text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised texts of the documents and of awkward literals."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")
    literals = spark.createDataFrame([(f"l{i}", t) for i, t in enumerate(_NORM)], "id string, text string")
    norm = text.norm_text(F.col("text"))
    return docs.unionByName(literals).select("id", F.md5(norm).alias("norm"), F.length(norm).cast("long").alias("chars"))


@query("strip_accents_text", f"SELECT doc_id, md5(translate(text, '{LATIN}', '{PLAIN}')) AS plain FROM documents")
def strip_accents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without accents, by the complete Unicode tables."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(text.strip_accents(F.col("text"))).alias("plain"))


@query("fragment_detector", r"""
WITH l AS (SELECT doc_id, trim(regexp_replace(x, '[\s\p{Z}]+', ' ', 'g')) AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents)),
w AS (SELECT doc_id, s, regexp_extract_all(lower(s), '[\p{L}\p{N}_]+') AS w, regexp_extract_all(lower(s), '[^\p{L}\p{N}_]+') AS g, regexp_matches(lower(s), '^[\p{L}\p{N}_]') AS head FROM l),
f AS (SELECT doc_id, regexp_matches(s, '\S-$') OR regexp_matches(s, '^-[a-záéíóúâêôãõç]') OR
      len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1] AND length(w[i]) <= 3 AND trim(g[CASE WHEN head THEN i ELSE i + 1 END]) = '')) > 0 AS bad FROM w)
SELECT doc_id, count(*) AS lines, count(*) FILTER (bad) AS fragments FROM f GROUP BY doc_id""")
def fragment_detector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document and those that look cut or stuttered."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(text.is_fragment(F.col("line"))).alias("fragments"))


_DATES = ["31/12/2025", "12/2025", "jun/25", "dez/2024", "texto qualquer", "2025-03-09", "mar. 2025", "15/03/2025 x", ""]
_PARSED = ["2025-12-31", "2025-12", "2025-06", "2024-12", "texto qualquer", "2025-03-09", "2025", "2025-03-15", None]
_MONTHED = ["2025-12", "2025-12", "2025-06", "2024-12", None, "2025-03", "2025-03", "2025-03", None]
_MONTH = [12, 0, 0, 0, 0, 3, 0, 3, 0]
_q = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


@query("parse_dates", f"""
SELECT 'l' || i AS id, p AS day, m AS month, CAST(n AS INTEGER) AS month_number FROM (VALUES {", ".join(f"({i}, {_q(p)}, {_q(m)}, {_q(n)})" for i, (p, m, n) in enumerate(zip(_PARSED, _MONTHED, _MONTH)))}) t(i, p, m, n)
UNION ALL SELECT 'o' || o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate, '%Y-%m'), CAST(month(o_orderdate) AS INTEGER) FROM orders""")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three readings of literal dates and of order dates written dd/mm/yyyy."""
    rows = spark.createDataFrame([(f"l{i}", t) for i, t in enumerate(_DATES)], "id string, t string")
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey")).alias("id"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("t"))
    t = F.col("t")
    return rows.unionByName(orders).select("id", dates.parse_date(t).alias("day"), dates.year_month(t).alias("month"), F.coalesce(dates.month_of(t), F.lit(0)).alias("month_number"))


@query("text_predicates", r"""
SELECT doc_id, CAST((contains(text, 'the'))::INT + (contains(text, 'und'))::INT + (contains(text, 'MIT License'))::INT AS INTEGER) AS hits,
  lower(trim(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g'))) = '' AS blank, CASE WHEN length(text) > 140 THEN substr(text, 1, 140) || '…' ELSE text END AS clip,
  'S:' || coalesce(source, 'None') || ' | L:' || coalesce(lang, 'None') AS label, replace(replace(lower(source || ' / ' || lang), ' ', '-'), '/', '-') AS slug
FROM documents""")
def text_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword hits, blankness, clipped text, labels and slugs of the documents."""
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.hits(t, ("the", "und", "MIT License")).alias("hits"), text.is_blank(t).alias("blank"), text.clip(t, 140, mark="…").alias("clip"), text.labelled(S=F.col("source"), L=F.col("lang")).alias("label"), text.slug(F.concat_ws(" / ", "source", "lang")).alias("slug"))


@query("number_formats", """
SELECT o_orderkey, translate(format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), ',', '.') AS whole,
  CASE WHEN o_totalprice * 10 < 1024 THEN CAST(CAST(floor(o_totalprice * 10) AS BIGINT) AS VARCHAR) || ' B' WHEN floor(o_totalprice * 10) < 1048576 THEN 'KB' ELSE 'MB' END AS unit,
  CASE WHEN o_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS flag, CAST(CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE round(o_orderkey * 100.0 / (o_custkey % 7), 1) END AS DOUBLE) AS pct
FROM orders""")
def number_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with swapped separators, units of size, flags as words and guarded percentages."""
    size = F.floor(F.col("o_totalprice") * 10)
    unit = text.size_text(size)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.swapped_number(F.floor("o_totalprice")).alias("whole"), F.when(unit.endswith(" B"), unit).otherwise(F.substring(unit, -2, 2)).alias("unit"),
        F.when(F.col("o_custkey") % 2 == 0, "yes").otherwise("no").alias("flag"), numbers.percent(F.col("o_orderkey"), F.col("o_custkey") % 7).alias("pct"),
    )


@query("html_links", r"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>[^<]*', 0)) AS a FROM pages),
x AS (SELECT page_id, regexp_extract(a, 'href="([^"]*)"', 1) AS href, regexp_extract(a, '>([^<]*)$', 1) AS anchor FROM l)
SELECT page_id, href, anchor, lower(href) LIKE '%.pdf' AS is_pdf, regexp_extract(href, '[^/]*$', 0) AS file,
  CASE WHEN contains(lower(anchor), 'home') THEN 'home' WHEN contains(lower(anchor), 'about') THEN 'about' WHEN contains(lower(regexp_extract(href, '[^/]*$', 0)), 'home') THEN 'home' WHEN contains(lower(regexp_extract(href, '[^/]*$', 0)), 'about') THEN 'about' END AS kind
FROM x""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages with their text, file and kind."""
    from corvina.sources.files import links

    found = links(table(spark, sf_dir, "pages"), "page_id", "html")
    return found.select("page_id", "href", "anchor", F.lower("href").endswith(".pdf").alias("is_pdf"), F.regexp_extract("href", "[^/]*$", 0).alias("file"), text.link_kind(F.col("anchor"), F.col("href"), (("home", ("home",)), ("about", ("about",)))).alias("kind"))


@query("header_codes", """
WITH h AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN ['N' || s_nationkey || 'A', 'SUP-' || s_suppkey] WHEN 1 THEN ['ANATEL'] WHEN 2 THEN ['SG-PR'] ELSE CAST([] AS VARCHAR[]) END AS codes FROM supplier)
SELECT s_suppkey, unnest(codes) AS code, CAST(generate_subscripts(codes, 1) - 1 AS INT) AS pos FROM h""")
def header_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of headers that name one or more bodies, each supplier's own among them."""
    k = F.col("s_suppkey")
    own = F.concat(F.lit("Plano de Transformação Digital N"), "s_nationkey", F.lit("A / SUP-"), k, F.lit(":"))
    h = F.when(k % 4 == 0, own).when(k % 4 == 1, "Plano de Transformação Digital ANATEL (NOVO):").when(k % 4 == 2, "Plano de Transformação Digital SG-PR:").otherwise(F.concat(F.lit("Plano de Transformação Digital texto "), F.lower("s_name")))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", h.alias("h"))
    return rows.select("s_suppkey", F.posexplode(text.header_codes(F.col("h"), r"Plano\s+de\s+Transforma[çc][ãa]o\s+Digital")).alias("pos", "code")).select("s_suppkey", "code", "pos")
