"""Queries for counts, rates, concentrations, timelines and similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvina.operators import analytics as A
from corvina.plans.catalog import query, table

LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("value_counts_topk", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 20")
def value_counts_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most frequent brands."""
    return A.top_k(table(spark, sf_dir, "part"), "p_brand", 20)


@query("value_counts_all", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type."""
    return A.value_counts(table(spark, sf_dir, "events"), "event_type")


@query("scale_counts_dropped", "SELECT CAST(pos AS INTEGER) AS pos, term, count(*) AS n FROM (VALUES (0,'view'),(1,'click'),(2,'absent')) t(pos, term) JOIN events ON event_type = term GROUP BY ALL")
def scale_counts_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per term of an ordered list, terms without events left out."""
    return A.scale_counts(table(spark, sf_dir, "events"), "event_type", ("view", "click", "absent"), keep_zero=False)


@query("crosstab_zero_fill", "SELECT p AS o_orderpriority, " + ", ".join(f"count(*) FILTER (o_orderstatus = '{s}') AS \"{s}\"" for s in "FOPX") + " FROM (VALUES ('1-URGENT'),('2-HIGH'),('3-MEDIUM'),('4-NOT SPECIFIED'),('5-LOW'),('6-NONE')) t(p) LEFT JOIN orders ON o_orderpriority = p GROUP BY p")
def crosstab_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and status, rows and columns without orders included."""
    return A.crosstab(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", (*LEVELS, "6-NONE"), tuple("FOPX"))


@query("explode_token_counts", "SELECT part, count(*) AS n FROM (SELECT trim(unnest(string_split(p_name, ' '))) AS part FROM part) WHERE part <> '' GROUP BY part")
def explode_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the part names."""
    return A.part_counts(table(spark, sf_dir, "part"), "p_name", " ")


@query("per_group_stats", """
WITH g AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY k)
SELECT count(*) AS groups, round(avg(n), 6) AS mean, median(n) AS median, CAST(floor(median(n)) AS BIGINT) AS median_int,
  (SELECT k FROM g ORDER BY n DESC, k LIMIT 1) AS largest, (SELECT k FROM g ORDER BY n, k LIMIT 1) AS smallest FROM g""")
def per_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, median, largest and smallest number of orders of a customer."""
    return A.group_stats(table(spark, sf_dir, "orders"), "o_custkey")


@query("concentration_top20", """
WITH g AS (SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS r, count(*) OVER () AS c FROM orders GROUP BY o_custkey),
k AS (SELECT *, greatest(1, CAST(floor(c * 0.2) AS BIGINT)) AS k FROM g)
SELECT max(c) AS groups, max(k) AS k, CAST(sum(n) FILTER (r <= k) AS BIGINT) AS top_rows, round(sum(n) FILTER (r <= k) / sum(n), 6) AS top_share FROM k""")
def concentration_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of all orders that the fifth of customers with most orders has."""
    return A.concentration(table(spark, sf_dir, "orders"), "o_custkey", 0.2)


@query("top2_share", "WITH g AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1), t AS (SELECT n FROM g ORDER BY n DESC, c_mktsegment LIMIT 2) SELECT CAST((SELECT sum(n) FROM t) AS BIGINT) AS top_rows, round((SELECT sum(n) FROM t) / (SELECT sum(n) FROM g), 6) AS share")
def top2_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the customers in the two largest segments."""
    customers = table(spark, sf_dir, "customer")
    top = A.top_k(customers, "c_mktsegment", 2).agg(F.sum("n").alias("top_rows"))
    return top.join(customers.agg(F.count("*").alias("all")), F.lit(True)).select("top_rows", F.round(F.col("top_rows") / F.col("all"), 6).alias("share"))


@query("distinct_pairs", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_type IN ('error', 'signup'))")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of user and type among two types of events."""
    return A.distinct_pairs(table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "signup")), "user_id", "event_type")


@query("set_equals_singleton", "SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING min(l_returnflag) = 'R' AND max(l_returnflag) = 'R'")
def set_equals_singleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders all of whose lines were returned."""
    return A.only_value(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", "R")


@query("breakdown_map", """SELECT o_custkey, '{' || string_agg('"' || s || '":' || n, ',' ORDER BY s) || '}' AS breakdown FROM (SELECT o_custkey, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey""")
def breakdown_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per status of each customer as JSON."""
    return A.breakdown(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus")


@query("monthly_counts", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month."""
    return A.monthly(table(spark, sf_dir, "orders"), F.date_format("o_orderdate", "yyyy-MM"))


@query("december_share", "SELECT count(*) AS dated, round(avg(CASE WHEN month(o_orderdate) = 12 THEN 1.0 ELSE 0.0 END), 6) AS share FROM orders")
def december_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of dated orders that fall in December, dates read from text."""
    from corvina.functions.dates import month_of

    m = table(spark, sf_dir, "orders").select(month_of(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("m")).where("m is not null")
    return m.agg(F.count("*").alias("dated"), F.round(F.avg((F.col("m") == 12).cast("double")), 6).alias("share"))


@query("jaccard_pairs", """
WITH s AS (SELECT DISTINCT p_brand AS k, o_custkey AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k), p AS (SELECT x.k AS a, y.k AS b, count(*) AS common FROM s x JOIN s y ON x.i = y.i AND x.k <= y.k GROUP BY ALL)
SELECT a, b, common, round(common / (x.n + y.n - common), 6) AS jaccard FROM p JOIN n x ON x.k = a JOIN n y ON y.k = b""")
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of brands by the customers who ordered them, over all orders; brands are few, so an item has few pairs."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return A.jaccard(lines, "p_brand", "o_custkey")


@query("missing_rate_unpivot", "WITH d AS (SELECT d.text, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)) " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS missing, round(count(*) FILTER ({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') / count(*), 6) AS rate FROM d" for c in ("text", "lang", "quality", "toxic")))
def missing_rate_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values of documents and their labels."""
    return A.missing_rates(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"), ["text", "lang", "quality", "toxic"])


@query("repeated_text_ge3", "SELECT doc_id, source FROM documents WHERE text IN (SELECT text FROM documents WHERE text <> '' GROUP BY text HAVING count(DISTINCT source) >= 3)")
def repeated_text_ge3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text stands in three sources or more."""
    return A.repeated_texts(table(spark, sf_dir, "documents"), "text", "source", 3).select("doc_id", "source")


@query("keyword_hits", "SELECT count(*) FILTER (contains(text, 'License')) AS license, count(*) FILTER (contains(text, 'idiot') OR contains(text, 'scum')) AS abuse, count(*) FILTER (length(text) < 100) AS short FROM documents")
def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with words of three kinds, from one scan."""
    from corvina.functions.text import contains_any

    t = F.col("text")
    return A.indicators(table(spark, sf_dir, "documents"), license=t.contains("License"), abuse=contains_any(t, ("idiot", "scum")), short=F.length(t) < 100)


@query("critical_zone", "SELECT count(*) FILTER (o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM') AND o_totalprice >= 200000) AS critical, count(*) FILTER (o_orderpriority = '1-URGENT' AND o_totalprice >= 300000) AS worst, count(*) AS total FROM orders")
def critical_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the upper three priorities and price bands, and at the top of both."""
    rank = F.array_position(F.array(*map(F.lit, LEVELS)), F.col("o_orderpriority"))
    band = F.when(F.col("o_totalprice") >= 300000, 3).when(F.col("o_totalprice") >= 200000, 2).otherwise(1)
    return A.indicators(table(spark, sf_dir, "orders"), critical=rank.between(1, 3) & (band >= 2), worst=(rank == 1) & (band == 3), total=F.lit(True))


@query("treatment_classes", """
WITH t AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'mitigar' WHEN 2 THEN 'mitigar; aceitar' WHEN 3 THEN 'outro' ELSE 'aceitar;outro' END AS x FROM orders)
SELECT class, count(*) AS n FROM (SELECT CASE x WHEN '' THEN 'empty' WHEN 'mitigar' THEN 'single' WHEN 'mitigar; aceitar' THEN 'composite' ELSE 'outside' END AS class FROM t) GROUP BY class""")
def treatment_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-valued treatments by class: empty, one term, several terms, or anything else."""
    from corvina.functions.vocabularies import TREATMENT

    k = F.col("o_orderkey") % 5
    x = F.when(k == 0, "").when(k == 1, "mitigar").when(k == 2, F.concat_ws("; ", F.lit("mitigar"), F.lit("aceitar"))).when(k == 3, "outro").otherwise("aceitar;outro")
    parts = F.filter(F.transform(F.split(x, ";"), lambda p: F.trim(p)), lambda p: p != "")
    known = F.forall(parts, lambda p: p.isin(*TREATMENT))
    kind = F.when(F.size(parts) == 0, "empty").when(~known, "outside").when(F.size(parts) == 1, "single").otherwise("composite")
    return A.value_counts(table(spark, sf_dir, "orders").select(kind.alias("class")), "class")


@query("residual_topn", "SELECT c_name, count(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND coalesce(c_name, '') <> '' GROUP BY c_name ORDER BY n DESC, c_name LIMIT 20")
def residual_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent values outside a vocabulary."""
    rest = table(spark, sf_dir, "customer").where(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.coalesce("c_name", F.lit("")) != ""))
    return A.top_k(rest, "c_name", 20)


@query("canonical_rates", "SELECT 'priority' AS name, count(*) FILTER (o_orderpriority IN ('1-URGENT', '5-LOW')) AS ok, count(*) AS total, round(count(*) FILTER (o_orderpriority IN ('1-URGENT', '5-LOW')) / count(*), 6) AS rate FROM orders UNION ALL SELECT 'status', count(*) FILTER (o_orderstatus IN ('F', 'O')), count(*), round(count(*) FILTER (o_orderstatus IN ('F', 'O')) / count(*), 6) FROM orders")
def canonical_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of rows whose value is a term, for two columns from one scan."""
    return A.rates(table(spark, sf_dir, "orders"), priority=F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), status=F.col("o_orderstatus").isin("F", "O"))


@query("nested_group_json", """
SELECT l_orderkey, count(*) AS total, '[' || string_agg('{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}', ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) || ']' AS entries FROM lineitem GROUP BY l_orderkey""")
def nested_group_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each order as ordered JSON."""
    return A.keyed_json(table(spark, sf_dir, "lineitem"), "l_orderkey", ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), ("l_linenumber", "l_partkey", "l_returnflag"))


@query("stable_sort_null_blank", "SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY coalesce(CAST(quality AS VARCHAR), ''), source, doc_id) AS place FROM documents LEFT JOIN labels USING (doc_id)")
def stable_sort_null_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place in its language by several keys, null as blank."""
    from pyspark.sql import Window

    w = Window.partitionBy("lang").orderBy(F.coalesce(F.col("quality").cast("string"), F.lit("")), "source", "doc_id")
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", F.row_number().over(w).cast("long").alias("place"))


@query("set_algebra", "SELECT 'both' AS side, count(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT 'unlabelled', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT 'all', count(*) FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)")
def set_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union, intersection and difference of two key sets."""
    a, b = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    sides = {"both": a.intersect(b), "unlabelled": a.subtract(b), "all": a.union(b).distinct()}
    out = None
    for name, df in sides.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("orders_per_customer_counts", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def orders_per_customer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of every customer, aggregated before the join."""
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "customer").join(n, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
