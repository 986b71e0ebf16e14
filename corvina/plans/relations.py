"""Queries for joins, windows, groups, review, harmonisation, checks and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvina.functions.vocabularies import PROBABILITY
from corvina.operators import canonical, groups, harmonize, quality, review
from corvina.plans.catalog import query, table


@query("vocab_mapping", "SELECT 'segment' AS type, c_mktsegment AS original, upper(c_mktsegment) AS normalized, count(*) AS n FROM customer GROUP BY ALL UNION ALL SELECT 'priority', o_orderpriority, substr(o_orderpriority, 3), count(*) FROM orders GROUP BY ALL")
def vocab_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every original spelling with its normal form and count, of two fields."""
    a = table(spark, sf_dir, "customer").groupBy(F.lit("segment").alias("type"), F.col("c_mktsegment").alias("original")).agg(F.min_by(F.upper("c_mktsegment"), "c_custkey").alias("normalized"), F.count("*").alias("n"))
    b = table(spark, sf_dir, "orders").groupBy(F.lit("priority").alias("type"), F.col("o_orderpriority").alias("original")).agg(F.min_by(F.expr("substr(o_orderpriority, 3)"), "o_orderkey").alias("normalized"), F.count("*").alias("n"))
    return a.unionByName(b)


@query("alt_labels", "SELECT upper(event_type) AS term, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS variants, count(*) AS n FROM events GROUP BY 1")
def alt_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of each canonical term that differ from it."""
    e = table(spark, sf_dir, "events")
    term = F.upper("event_type")
    return e.groupBy(term.alias("term")).agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("event_type") != term, F.col("event_type")))), ",").alias("variants"), F.count("*").alias("n"))


@query("first_occurrence_flag", "SELECT event_id, event_id = min(event_id) OVER (PARTITION BY event_type) AS is_first FROM events")
def first_occurrence_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an event is its type's first."""
    return canonical.first_of(table(spark, sf_dir, "events"), F.col("event_type"), "event_id").select("event_id", "is_first")


@query("xval_override", """
WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN 'WRONG' ELSE r_name END AS region, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT c_custkey, r_name AS region, region <> r_name AS overridden FROM c""")
def xval_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions corrected by the nation's own."""
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    c = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, "WRONG").otherwise(F.col("r_name")).alias("region"))
    return canonical.override(c, "c_nationkey", "region", nation).select("c_custkey", "region", "overridden")


@query("fragment_split", "SELECT doc_id, length(trim(text)) < 40 AS dropped FROM documents")
def fragment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents too short to be kept."""
    return table(spark, sf_dir, "documents").select("doc_id", (F.length(F.trim("text")) < 40).alias("dropped"))


@query("dedupe_md5_owner", "SELECT doc_id, md5(text) AS content_md5, min(doc_id) OVER (PARTITION BY text) AS owner_key, doc_id = min(doc_id) OVER (PARTITION BY text) AS is_owner FROM documents")
def dedupe_md5_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document with each text owns it."""
    return groups.own_by_content(table(spark, sf_dir, "documents"), F.col("text"), "doc_id").select("doc_id", "content_md5", "owner_key", "is_owner")


_NATIONS = "n AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey), s AS (SELECT s_nationkey, min(s_name) AS s_name FROM supplier GROUP BY 1)"


@query("group_expand", f"""
WITH {_NATIONS}, e AS (SELECT n_name AS entity, s_name AS url FROM n LEFT JOIN s ON s_nationkey = n_nationkey UNION ALL SELECT r_name, 'url of ' || r_name FROM region),
m AS (SELECT r_name AS head, n_name AS member FROM n UNION ALL SELECT r_name, r_name || ' BRANCH' FROM region),
x AS (SELECT coalesce(e.entity, m.member) AS entity, e.url, m.head FROM e FULL JOIN m ON m.member = e.entity)
SELECT x.entity, coalesce(x.url, h.url) AS url, CASE WHEN x.url IS NULL THEN x.head END AS inherited_from FROM x LEFT JOIN e h ON h.entity = x.head""")
def group_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and missing members of their regions, with the region's value where they have none."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    n = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.min("s_name").alias("url"))
    e = n.join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(F.col("n_name").alias("entity"), "url")
    e = e.unionByName(region.select(F.col("r_name").alias("entity"), F.concat(F.lit("url of "), "r_name").alias("url")))
    m = n.select(F.col("r_name").alias("head"), F.col("n_name").alias("member")).unionByName(region.select(F.col("r_name").alias("head"), F.concat("r_name", F.lit(" BRANCH")).alias("member")))
    return groups.expand_members(e, m, "entity", "url")


_COVER = """
WITH k AS (SELECT n_nationkey, n_name, n_regionkey, count(s_suppkey) AS own FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY ALL),
p AS (SELECT *, CAST(sum(own) OVER (PARTITION BY n_regionkey) AS BIGINT) - own AS peers FROM k),
e AS (SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN NULL WHEN n_nationkey % 4 = 1 THEN 'no_table' END AS err FROM nation),
st AS (SELECT n_name AS entity, own, peers, CASE WHEN own > 0 THEN 'ok' WHEN peers > 0 THEN 'shared' WHEN p.n_nationkey % 5 = 0 THEN 'no_source' ELSE coalesce(err, 'no_rows') END AS status FROM p JOIN e USING (n_nationkey))"""


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    own = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    e = nation.join(own, F.col("n_nationkey") == F.col("s_nationkey"), "left").select(F.col("n_name").alias("entity"), "n_nationkey", F.coalesce("n", F.lit(0)).cast("long").alias("own"))
    members = nation.select(F.col("n_regionkey").alias("head"), F.col("n_name").alias("member"))
    errors = nation.where("n_nationkey % 4 = 1").select(F.col("n_name").alias("k"), F.explode(F.array(F.struct(F.lit(1).alias("ord"), F.lit("no_table").alias("err")), F.struct(F.lit(2).alias("ord"), F.lit("late").alias("err")))).alias("x")).select("k", "x.*")
    first = groups.first_error(errors, "k", "err", "ord")
    c = groups.covered(e, members, "entity", "own").join(first, F.col("entity") == F.col("k"), "left")
    source = F.when(F.col("n_nationkey") % 5 != 0, F.lit("url"))
    return c.select("entity", "own", F.col("peer_rows").alias("peers"), groups.coverage_status(c, "own", "peer_rows", source, F.col("err")).alias("status"))


@query("coverage_status", _COVER + "SELECT * FROM st")
def coverage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each nation is covered: by itself, by its region, or why not."""
    return _covered(spark, sf_dir)


@query("group_covered_semi", _COVER + "SELECT count(*) FILTER (status IN ('ok', 'shared')) AS covered, count(*) FILTER (status = 'ok') AS own, count(*) FILTER (status = 'shared') AS shared, count(*) AS entities FROM st")
def group_covered_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of all nations in figures."""
    s = F.col("status")
    return _covered(spark, sf_dir).agg(F.count_if(s.isin("ok", "shared")).alias("covered"), F.count_if(s == "ok").alias("own"), F.count_if(s == "shared").alias("shared"), F.count("*").alias("entities"))


@query("first_month_signatures", """
WITH f AS (SELECT c_custkey, c_nationkey, min(strftime(o_orderdate, '%Y-%m')) AS m FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
g AS (SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN min(m) OVER (PARTITION BY c_nationkey) ELSE m END AS m FROM f)
SELECT m AS month, count(*) AS n FROM g GROUP BY m""")
def first_month_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by their first month, in ten nations the nation's first."""
    customers = table(spark, sf_dir, "customer")
    first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c")).agg(F.min(F.date_format("o_orderdate", "yyyy-MM")).alias("month"))
    members = customers.where("c_nationkey < 10").join(first, F.col("c_custkey") == F.col("c"), "left_semi").select(F.col("c_nationkey").alias("head"), F.col("c_custkey").alias("member"))
    return groups.group_minimum(first, members, "c", "month").groupBy("month").agg(F.count("*").alias("n"))


@query("review_queue_union", """
SELECT CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 3 END AS INTEGER) AS priority, 'c' || o_custkey AS owner, 'delivery' AS kind, 'não reconhecido' AS issue, o_orderpriority AS original_value, o_orderstatus AS current_value, CASE WHEN o_orderpriority = '1-URGENT' THEN 'low' ELSE 'high' END AS confidence FROM orders
UNION ALL SELECT 4, 's' || l_suppkey, 'risk', 'fuzzy', l_returnflag, l_linestatus, 'medium' FROM lineitem
UNION ALL SELECT 1, 'u' || user_id, 'error', event_type, '', '', 'low' FROM events WHERE event_type = 'error'""")
def review_queue_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One queue of all orders and lines as entries to review, and of the errors among the events."""
    lit = F.lit
    conf = F.when(F.col("o_orderpriority") == "1-URGENT", "low").otherwise("high")
    a = table(spark, sf_dir, "orders").select(review.delivery_priority(lit("não reconhecido"), conf).alias("priority"), F.concat(lit("c"), "o_custkey").alias("owner"), lit("delivery").alias("kind"), lit("não reconhecido").alias("issue"), F.col("o_orderpriority").alias("original_value"), F.col("o_orderstatus").alias("current_value"), conf.alias("confidence"))
    b = table(spark, sf_dir, "lineitem").select(review.risk_priority(lit("fuzzy"), lit("medium")).alias("priority"), F.concat(lit("s"), "l_suppkey").alias("owner"), lit("risk").alias("kind"), lit("fuzzy").alias("issue"), F.col("l_returnflag").alias("original_value"), F.col("l_linestatus").alias("current_value"), lit("medium").alias("confidence"))
    c = table(spark, sf_dir, "events").where("event_type = 'error'").select(lit(1).alias("priority"), F.concat(lit("u"), "user_id").alias("owner"), lit("error").alias("kind"), F.col("event_type").alias("issue"), lit("").alias("original_value"), lit("").alias("current_value"), lit("low").alias("confidence"))
    return review.queue(a, b, c)


@query("review_buckets", """
WITH f AS (SELECT 'priority' AS field, o_orderpriority AS original, 'c' || (o_custkey % 9) AS owner, o_orderkey AS ord, 'k' || o_orderkey AS context, (o_custkey % 4) / 4.0 AS score, o_orderstatus AS method, 'm' || (o_orderkey % 3) AS match FROM orders
  UNION ALL SELECT 'status', o_orderstatus, 'c' || (o_custkey % 9), o_orderkey, 'k' || o_orderkey, (o_custkey % 4) / 4.0, o_orderstatus, 'm' || (o_orderkey % 3) FROM orders),
x AS (SELECT field, original, string_agg(owner || '/' || context, '; ' ORDER BY ord) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY field, original ORDER BY ord) AS r FROM f) WHERE r <= 5 GROUP BY ALL)
SELECT field, original, count(*) AS n, string_agg(DISTINCT owner, ',' ORDER BY owner) AS groups, CAST(min(score) AS DOUBLE) AS score_min, CAST(max(score) AS DOUBLE) AS score_max, arg_max(method, ord) AS method, arg_max(match, ord) AS match, x.examples, CAST(round(count(*) * (1 - min(score)), 6) AS DOUBLE) AS impact
FROM f JOIN x USING (field, original) GROUP BY field, original, x.examples""")
def review_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of two fields with their counts, owners, scores and first examples."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("c"), F.col("o_custkey") % 9).alias("owner"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("k"), "o_orderkey").alias("context"), ((F.col("o_custkey") % 4) / 4.0).alias("score"), F.col("o_orderstatus").alias("method"), F.concat(F.lit("m"), F.col("o_orderkey") % 3).alias("match"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return review.buckets(o.unpivot(["owner", "ord", "context", "score", "method", "match"], ["priority", "status"], "field", "original"))


@query("review_summaries", "SELECT 'lang' AS by, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def review_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language and by source, from one pass."""
    return review.summaries(table(spark, sf_dir, "documents"), "lang", "source")


_FIX = [(1, "AUTOMOBILE", "VEHICLE"), (2, "BUILDING", "HOUSE"), (3, "NOTHING", "X"), (4, "MACHINERY", "TOOLS"), (5, "AUTOMOBILE", "CAR")]


@query("apply_corrections", f"""
WITH f AS (SELECT * FROM (VALUES {', '.join(f"({i}, {n}, '{o}', '{c}')" for n in range(25) for i, o, c in [(5 * n + a, b, c) for a, b, c in _FIX])}) t(ord, nation, original, corrected)),
r AS (SELECT c_custkey, c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS n FROM customer),
w AS (SELECT *, row_number() OVER (PARTITION BY nation, original ORDER BY ord) AS n FROM f)
SELECT r.c_custkey, coalesce(w.corrected, r.c_mktsegment) AS c_mktsegment, CASE WHEN w.ord IS NULL THEN '' ELSE 'c_mktsegment' END AS corrected_fields
FROM r LEFT JOIN w ON w.nation = r.c_nationkey AND w.original = r.c_mktsegment AND w.n = r.n""")
def apply_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer segments corrected by a batch of which each entry changes one row."""
    fixes = spark.createDataFrame([(5 * n + a, n, "c_mktsegment", b, c) for n in range(25) for a, b, c in _FIX], "ord long, c_nationkey int, field string, original string, corrected string")
    out, _ = review.apply_corrections(table(spark, sf_dir, "customer"), fixes, key="c_nationkey", order="c_custkey", fields=("c_mktsegment",))
    return out.select("c_custkey", "c_mktsegment", "corrected_fields")


_CELLS = ["raro", "raro; raro", "raro; provável", "de de Ocor-", "nan", "", " provável ", "raro|raro", "algo"]
_VALUES = [("raro", None), ("raro", "deduplicated"), ("", "multiple_values"), ("", "column_bleed"), ("", None), ("", None), ("provável", None), ("raro", "deduplicated"), ("", "column_bleed")]
_SQL_CELLS = "c AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{b}', '{a}', {'NULL' if r is None else chr(39) + r + chr(39)})" for i, (b, (a, r)) in enumerate(zip(_CELLS, _VALUES))) + ") t(k, before, after, reason)), o AS (SELECT o_orderkey, o_custkey, before, after, reason FROM orders JOIN c ON k = o_orderkey % 9)"


def _harmonized(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cells = F.array(*map(F.lit, _CELLS))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("owner"), F.get(cells, (F.col("o_orderkey") % 9).cast("int")).alias("probability"))
    return harmonize.harmonize(o, {"probability": PROBABILITY}, order="o_orderkey", owner="owner")


@query("harmonize_cells", f"WITH {_SQL_CELLS} SELECT o_orderkey, after AS probability, coalesce(reason IN ('multiple_values', 'column_bleed'), false) AS needs_review, CASE WHEN reason IN ('multiple_values', 'column_bleed') THEN 'harmonized(probability:' || reason || ')' END AS review_reason FROM o")
def harmonize_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict cells with their review marks."""
    return _harmonized(spark, sf_dir)[0].select("o_orderkey", "probability", "needs_review", "review_reason")


@query("harmonize_log", f"WITH {_SQL_CELLS} SELECT o_orderkey AS row, CAST(o_custkey AS VARCHAR) AS owner, 'probability' AS field, before, after, reason FROM o WHERE reason IS NOT NULL AND before <> after")
def harmonize_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What harmonisation changed and why."""
    return _harmonized(spark, sf_dir)[1]


@query("harmonize_counts", f"WITH {_SQL_CELLS} SELECT reason, count(*) AS n FROM o WHERE reason IS NOT NULL AND before <> after GROUP BY reason")
def harmonize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes by reason."""
    return _harmonized(spark, sf_dir)[1].groupBy("reason").agg(F.count("*").alias("n"))


@query("quality_gate", """
SELECT 'orders' AS name, 'max' AS kind, CAST(10000000 AS DOUBLE) AS bound, CAST(count(*) AS DOUBLE) AS actual, count(*) <= 10000000 AS passed FROM orders
UNION ALL SELECT 'finished', 'min', 0.4, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6), round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) >= 0.4 FROM orders""")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of the orders against bounds."""
    return quality.checks(table(spark, sf_dir, "orders"), {"orders": ("max", 10_000_000), "finished": ("min", 0.4)}, orders=F.count("*"), finished=F.avg((F.col("o_orderstatus") == "F").cast("double")))


@query("constraint_violations", """
SELECT 'lineitem' AS "table", 'key' AS rule, count(*) AS n FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'without lines', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'documents', 'without label', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'orders', 'o_orderstatus enum', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'orders', 'o_totalprice range', count(*) FROM orders WHERE NOT o_totalprice BETWEEN 0 AND 300000""")
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break keys, references, enumerations and ranges."""
    orders, lines, docs = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "documents"))
    count = lambda df, t, rule: df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table"), F.lit(rule).alias("rule"), "n")
    out = count(quality.duplicate_keys(lines, "l_orderkey", "l_linenumber"), "lineitem", "key")
    out = out.unionByName(count(quality.orphans(orders, "o_orderkey", lines, "l_orderkey"), "orders", "without lines"))
    out = out.unionByName(count(quality.orphans(docs, "doc_id", table(spark, sf_dir, "labels"), "doc_id"), "documents", "without label"))
    broken = quality.violations(orders, enums={"o_orderstatus": ("F", "O")}, ranges={"o_totalprice": (0, 300000)})
    return out.unionByName(broken.select(F.lit("orders").alias("table"), F.concat_ws(" ", "column", "rule").alias("rule"), "n"))


@query("sequential_letter_id", "SELECT event_id, user_id, CASE WHEN n <= 26 THEN chr(CAST(64 + n AS INTEGER)) ELSE 'R' || n END AS item_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)")
def sequential_letter_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user lettered in order."""
    return groups.letter_ids(table(spark, sf_dir, "events"), "user_id", "event_id").select("event_id", "user_id", "item_id")


_HASHED = "SELECT '{0}' AS \"table\", count(*) AS rows, CAST(coalesce(sum(CAST(CAST('0x' || substr(md5({1}), 1, 15) AS BIGINT) AS HUGEINT)), 0) AS VARCHAR) AS fingerprint FROM {0}"


@query("manifest", " UNION ALL ".join(_HASHED.format(t, " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)) for t, cols in (("region", ("r_regionkey", "r_name")), ("nation", ("n_nationkey", "n_name", "n_regionkey")), ("labels", ("doc_id", "quality", "toxic")))))
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and fingerprints of three tables."""
    from corvina.sources.files import manifest as of

    return of(spark, region=table(spark, sf_dir, "region").select("r_regionkey", "r_name"), nation=table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), labels=table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


@query("islands_consolidate", "SELECT conv_id, block, count(*) AS turns, string_agg(text, ' | ' ORDER BY turn) AS text FROM (SELECT *, CAST(count(*) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block FROM conversations) GROUP BY conv_id, block")
def islands_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns joined from one user turn to the next."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    c = table(spark, sf_dir, "conversations").withColumn("block", F.count_if(F.col("role") == "user").over(w))
    return c.groupBy("conv_id", "block").agg(F.count("*").alias("turns"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " | ").alias("text"))


@query("carry_forward_header", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked FROM conversations")
def carry_forward_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last user turn so far."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("text")), ignorenulls=True).over(w).alias("asked"))


@query("lag_lead_context", """SELECT conv_id, turn, lag(role) OVER w AS before, lead(role) OVER w AS after, first_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING) IS NOT NULL AS answered
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def lag_lead_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns around each turn, and whether an answer follows within four."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    answer = F.first(F.when(F.col("role") == "assistant", F.col("turn")), ignorenulls=True).over(w.rowsBetween(1, 4))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lag("role").over(w).alias("before"), F.lead("role").over(w).alias("after"), answer.isNotNull().alias("answered"))


@query("best_of_two", """
WITH a AS (SELECT conv_id, turn, 'a' AS method FROM conversations WHERE role <> 'system'), b AS (SELECT conv_id, turn, 'b' AS method FROM conversations WHERE length(text) > 40),
n AS (SELECT conv_id, count(*) FILTER (method = 'a') AS na, count(*) FILTER (method = 'b') AS nb FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY conv_id)
SELECT x.conv_id, turn, method FROM (SELECT * FROM a UNION ALL SELECT * FROM b) x JOIN n ON n.conv_id = x.conv_id WHERE method = CASE WHEN na >= nb THEN 'a' ELSE 'b' END""")
def best_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two selections of turns the one with more rows, conversation by conversation."""
    from corvina.operators.tables import better_of

    c = table(spark, sf_dir, "conversations")
    return better_of(c.where("role <> 'system'").select("conv_id", "turn"), c.where("length(text) > 40").select("conv_id", "turn"), "conv_id")


_TREATED = {"mitigar; transferir": ("mitigar; transferir", 1.0, 2), "reduzir": ("mitigar", 0.95, 1), "mitigar/transferir": ("mitigar; transferir", 0.95, 2), "Aceitar, evitar": ("aceitar; eliminar", 0.95, 2), "": ("", 0.0, 0)}


@query("composite_treatments", f"""
SELECT o_orderkey, raw, treatment_value, CAST(treatment_score AS DOUBLE) AS treatment_score, treatment_parts FROM orders
JOIN (VALUES {", ".join(f"({i}, '{k}', '{v}', {s}, {n})" for i, (k, (v, s, n)) in enumerate(_TREATED.items()))}) t(i, raw, treatment_value, treatment_score, treatment_parts) ON i = o_orderkey % {len(_TREATED)}""")
def composite_treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-valued treatments of all orders, each part matched, scored by the worst."""
    from corvina.functions.vocabularies import TREATMENTS

    raw = F.get(F.array(*map(F.lit, _TREATED)), F.pmod("o_orderkey", F.lit(len(_TREATED))).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return canonical.composite(rows, "raw", "o_orderkey", TREATMENTS)
