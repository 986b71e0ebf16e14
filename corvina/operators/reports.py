"""Figures over standardised deliveries and risks: queues, summaries and metrics in one row each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvina.functions.numbers import ratio
from corvina.functions.vocabularies import AXES, IMPACT, PROBABILITY, TREATMENT
from corvina.operators import review
from corvina.operators.analytics import top_k, value_counts
from corvina.sources.shared import kept

EXPORT = ("owner", "entry_type", "field", "original_value", "current_value", "axis_original", "axis_value", "confidence", "review_reason", "service", "table_kind")
#: The upper levels of both scales, and those that make a risk critical.
CRITICAL_PROBABILITY, CRITICAL_IMPACT = PROBABILITY[2:], IMPACT[3:]


def _or_blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _three(suffix: str) -> Column:
    """The three fields of a risk in one text."""
    return F.concat(F.lit("P:"), _or_blank(f"probability{suffix}"), F.lit(" | I:"), _or_blank(f"impact{suffix}"), F.lit(" | T:"), _or_blank(f"treatment{suffix}"))


def export_queue(deliveries: DataFrame, risks: DataFrame) -> DataFrame:
    """Rows under review of both kinds with eleven columns in common, not ranked; null texts are blank.

    Deliveries need owner, service and table_kind, risks owner and risk, besides what standardising gives.
    """
    d = deliveries.where("needs_review").select("owner", F.lit("delivery").alias("entry_type"), F.lit("produto / eixo").alias("field"), _or_blank("product").alias("original_value"), F.col("product_value").alias("current_value"), _or_blank("axis").alias("axis_original"), F.col("axis_value"), "confidence", _or_blank("review_reason").alias("review_reason"), _or_blank("service").alias("service"), _or_blank("table_kind").alias("table_kind"))
    blank = F.lit("")
    r = risks.where("needs_review").select("owner", F.lit("risk").alias("entry_type"), F.lit("probabilidade / impacto / tratamento").alias("field"), _three("").alias("original_value"), _three("_value").alias("current_value"), blank.alias("axis_original"), blank.alias("axis_value"), "confidence", _or_blank("review_reason").alias("review_reason"), F.substring(_or_blank("risk"), 1, 100).alias("service"), blank.alias("table_kind"))
    return d.unionByName(r).select(*EXPORT)


def ranked_queue(deliveries: DataFrame, risks: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """The queue of rows under review and of errors (owner, kind, issue, value), by priority, owner and kind."""
    why = F.coalesce("review_reason", F.lit("needs review"))
    d = deliveries.where("needs_review").select(review.delivery_priority(F.col("review_reason"), F.col("confidence")).alias("priority"), "owner", F.lit("delivery").alias("kind"), why.alias("issue"), _or_blank("product").alias("original_value"), F.col("product_value").alias("current_value"), "confidence")
    r = risks.where("needs_review").select(review.risk_priority(F.col("review_reason"), F.col("confidence")).alias("priority"), "owner", F.lit("risk").alias("kind"), why.alias("issue"), _three("").alias("original_value"), _three("_value").alias("current_value"), "confidence")
    parts = [d, r]
    if errors is not None:
        parts.append(errors.select(F.lit(1).alias("priority"), "owner", F.concat(F.lit("error ("), "kind", F.lit(")")).alias("kind"), "issue", _or_blank("value").alias("original_value"), F.lit("").alias("current_value"), F.lit("failed").alias("confidence")))
    return review.queue(*parts).orderBy("priority", "owner", "kind")


def queue_breakdown(queue: DataFrame, owners: int = 10) -> DataFrame:
    """(by, value, n): a queue by priority, by kind, and its ``owners`` largest owners, ties to the smaller name."""
    some = review.summaries(queue, "priority", "kind")
    return some.unionByName(top_k(queue, "owner", owners).select(F.lit("owner").alias("by"), F.col("owner").cast("string").alias("value"), "n"))


def field_rows(df: DataFrame, fields: Sequence[str], *, context: str, owner: str = "owner", order: str = "ord") -> DataFrame:
    """(field, original, owner, ord, context, score, method, match): one row per row and standardised field, from one scan."""
    one = [F.struct(F.lit(f).alias("field"), F.col(f).alias("original"), F.col(f"{f}_score").alias("score"), F.col(f"{f}_method").alias("method"), F.col(f"{f}_value").alias("match")) for f in fields]
    rows = df.select(F.col(owner).alias("owner"), F.col(order).alias("ord"), F.col(context).alias("context"), F.explode(F.array(*one)).alias("x"))
    return rows.select("x.field", "x.original", "owner", "ord", "context", "x.score", "x.method", "x.match")


def field_buckets(rows: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Buckets of doubtful values of all fields, matched by one of ``methods``: the greatest impact first, then count, field and text.

    The doubtful rows, few among all, are kept, so that what they come from is computed once.
    """
    out = review.buckets(kept(rows.where(F.col("method").isin(*methods))))
    return out.orderBy(F.desc("impact"), F.desc("n"), "field", "original")


def ascending_top(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values from the least to the most frequent, as a plot of bars reads them."""
    return top_k(df, col, k).orderBy("n", F.desc(col))


def quality_score(*tables: DataFrame) -> DataFrame:
    """(high, total, score): rows of high confidence as a percentage of all rows of all tables, 0 of none."""
    every = [t.agg(F.count_if(F.col("confidence") == "high").alias("high"), F.count("*").alias("total")) for t in tables]
    both = every[0]
    for one in every[1:]:
        both = both.unionByName(one)
    both = both.agg(F.sum("high").alias("high"), F.sum("total").alias("total"))
    return both.withColumn("score", F.round(ratio(F.col("high"), F.col("total")) * 100, 6))


def _canonical(scale: Sequence[str], col: str) -> Column:
    return F.coalesce(F.col(col).isin(*scale), F.lit(False))


def residuals_by_owner(risks: DataFrame) -> DataFrame:
    """(owner, n): risks whose probability or impact isn't on its scale; owners without one are absent."""
    return value_counts(risks.where(~(_canonical(PROBABILITY, "probability_value") & _canonical(IMPACT, "impact_value"))), "owner")


def resolved_score(score: str, method: str, found_score: Column, found_method: Column) -> tuple[Column, Column]:
    """A row's stored score and method, or those found anew where it stores neither."""
    stored = (F.coalesce(method, F.lit("")) != "") | (F.coalesce(score, F.lit(0.0)) > 0)
    return F.when(stored, F.coalesce(score, F.lit(0.0))).otherwise(found_score), F.when(stored, F.coalesce(method, F.lit(""))).otherwise(found_method)


def document_counts(owners: DataFrame, first: str, second: str, group: str) -> DataFrame:
    """One row of how many owners have each of two documents, both, either, none; all documents; members of groups, and owners that hold theirs."""
    a, b, g = F.col(first).isNotNull(), F.col(second).isNotNull(), F.col(group).isNotNull()
    tests = {"owners": F.lit(True), "with_first": a, "with_second": b, "with_both": a & b, "with_none": ~a & ~b, "grouped": g, "holders": (a | b) & ~g}
    one = owners.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    return one.withColumn("documents", F.col("with_first") + F.col("with_second"))


def export_totals(log: DataFrame) -> DataFrame:
    """One row of an export's log (name, rows): files and rows."""
    return log.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))


def delivery_metrics(deliveries: DataFrame) -> DataFrame:
    """One row of figures on deliveries: totals, rows under review, corrected axes, fragments, products used, owners of two products."""
    why, product = F.coalesce("review_reason", F.lit("")), F.col("product_value")
    return deliveries.agg(
        F.count("*").alias("deliveries"), F.count_distinct("owner").alias("owners"), F.count_distinct("product_value").alias("products"),
        F.count_if("needs_review").alias("needs_review"), F.count_if(why.contains("cross-validation") | why.contains("eixo corrigido")).alias("corrected_axes"),
        F.count_if(product == "Outros").alias("other"), F.count_if((product == "Outros") & (F.length(F.trim(_or_blank("service"))) < 10)).alias("fragments"),
        F.count_distinct(F.when(product == "Implementação do PPSI", F.col("owner"))).alias("ppsi_owners"), F.count_distinct(F.when(product == "Integração ao Login Único", F.col("owner"))).alias("login_owners"),
    )


def treatment_class(col: str) -> Column:
    """empty, single, composite or outside: how a treatment of parts stands to the list of treatments."""
    parts = F.filter(F.transform(F.split(_or_blank(col), ";"), lambda p: F.trim(p)), lambda p: p != "")
    known = F.forall(parts, lambda p: p.isin(*TREATMENT))
    return F.when(F.trim(_or_blank(col)) == "", "empty").when((F.size(parts) == 0) | ~known, "outside").when(F.trim(_or_blank(col)).isin(*TREATMENT), "single").otherwise("composite")


def risk_metrics(risks: DataFrame) -> DataFrame:
    """One row of figures on risks: totals, canonical levels, treatments by class, critical and gravest risks, rows under review."""
    p, i = _canonical(PROBABILITY, "probability_value"), _canonical(IMPACT, "impact_value")
    kind = treatment_class("treatment_value")
    critical = _canonical(CRITICAL_PROBABILITY, "probability_value") & _canonical(CRITICAL_IMPACT, "impact_value")
    gravest = (F.col("probability_value") == PROBABILITY[-1]) & (F.col("impact_value") == IMPACT[-1])
    tests = {"probability_canonical": p, "impact_canonical": i, "both_canonical": p & i, **{f"treatment_{k}": kind == k for k in ("empty", "single", "composite", "outside")}, "critical": critical, "gravest": gravest, "needs_review": F.col("needs_review")}
    return risks.agg(F.count("*").alias("risks"), F.count_distinct("owner").alias("owners"), *[F.count_if(t).alias(n) for n, t in tests.items()])


def summary(deliveries: DataFrame, risks: DataFrame) -> DataFrame:
    """One row: totals and owners of both tables, canonical risks, mean and median deliveries per owner, and distributions as JSON.

    The distributions count every level of the two scales, every treatment, and the axes; the five most frequent products stand in order.
    """
    canonical = _canonical(PROBABILITY, "probability_value") & _canonical(IMPACT, "impact_value")
    levels = {f"{name}_{k}": (f"{name}_value", level) for name, scale in (("p", PROBABILITY), ("i", IMPACT), ("t", TREATMENT)) for k, level in enumerate(scale)}
    column = {"p_value": "probability_value", "i_value": "impact_value", "t_value": "treatment_value"}
    counts = risks.agg(F.count("*").alias("risks"), F.count_distinct("owner").alias("risk_owners"), F.count_if(canonical).alias("canonical_risks"), *[F.count_if(F.col(column[c]) == level).alias(n) for n, (c, level) in levels.items()])
    shape = lambda name, scale: F.to_json(F.struct(*[F.col(f"{name}_{k}").alias(level) for k, level in enumerate(scale)]))
    counts = counts.select("risks", "risk_owners", "canonical_risks", shape("p", PROBABILITY).alias("probability"), shape("i", IMPACT).alias("impact"), shape("t", TREATMENT).alias("treatment"))
    by = review.summaries(deliveries, "owner", "axis_value", "product_value")
    of = lambda name, c="n": F.when(F.col("by") == name, F.col(c))
    listed = lambda name, x: F.array_sort(F.collect_list(F.when((F.col("by") == name) & F.col("value").isNotNull(), x)))
    top = F.slice(F.transform(listed("product_value", F.struct((-F.col("n")).alias("m"), "value")), lambda x: x["value"]), 1, 5)
    per = by.agg(
        F.coalesce(F.sum(of("owner")), F.lit(0)).alias("deliveries"), F.count_if(F.col("by") == "owner").alias("delivery_owners"), F.round(F.avg(of("owner")), 1).alias("mean"), F.floor(F.median(of("owner"))).cast("long").alias("median"),
        F.to_json(F.map_from_entries(listed("axis_value", F.struct("value", "n")))).alias("axes"), F.array_join(top, "; ").alias("top_products"),
    )
    return per.withColumn("__one", F.lit(1)).join(counts.withColumn("__one", F.lit(1)), "__one").drop("__one")  # a row each


#: Kinds of errors that say a document gave nothing, as its scan would.
FAILED = ("no_risk_table", "no_data", "empty_table", "scan", "ocr_required")


def statistics(deliveries: DataFrame, risks: DataFrame, bodies: DataFrame, errors: DataFrame, groups: DataFrame, run_date: str) -> DataFrame:
    """One row with the eighteen figures of the public statistics, distributions as JSON objects.

    ``bodies`` has owner, directive and delivery, the places of a body's two documents or null; ``errors`` has owner, document and
    kind; ``groups`` (head, member) share what any of them has. Values off a list are left out of its distribution, and so are
    axes and treatments that no row has. Each of the four tables is read once.
    """
    value = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    listed = lambda scale, of: F.to_json(F.map_filter(F.map_from_arrays(F.array(*map(F.lit, scale)), F.array(*[of(i) for i in range(len(scale))])), lambda k, n: n > 0))
    whole = lambda scale, of: F.to_json(F.map_from_arrays(F.array(*map(F.lit, scale)), F.array(*[of(i) for i in range(len(scale))])))
    d = kept(review.summaries(deliveries, "owner", "axis_value", "product_value"))
    tests = {f"p{i}": F.col("probability_value") == v for i, v in enumerate(PROBABILITY)} | {f"i{i}": F.col("impact_value") == v for i, v in enumerate(IMPACT)}
    parts = F.transform(F.split(value("treatment_value"), ";"), lambda x: F.trim(x))
    sums = {f"t{i}": F.size(parts) - F.size(F.array_remove(parts, v)) for i, v in enumerate(TREATMENT)}
    both = _canonical(PROBABILITY, "probability_value") & _canonical(IMPACT, "impact_value")
    r = kept(risks.groupBy("owner").agg(F.count("*").alias("n"), F.count_if(both).alias("canonical"), *[F.count_if(t).alias(n) for n, t in tests.items()], *[F.sum(t).alias(n) for n, t in sums.items()]))

    def holders(having: DataFrame) -> DataFrame:
        """How many bodies have rows, a group's members all where one of them has."""
        shared = groups.join(groups.join(having, F.col("member") == F.col("owner"), "left_semi").select("head").distinct(), "head").select(F.col("member").alias("owner"))
        return having.unionByName(shared).agg(F.count_distinct("owner").alias("n"))

    by = lambda name: F.col("by") == name
    of = lambda name: F.when(by(name), F.col("n"))
    filled = F.coalesce("value", F.lit("")) != ""
    ranked = F.slice(F.array_sort(F.collect_list(F.when(by("product_value") & filled, F.struct((-F.col("n")).alias("m"), "value")))), 1, 5)
    axis = lambda i: F.coalesce(F.sum(F.when(by("axis_value") & (F.col("value") == AXES[i]), F.col("n"))), F.lit(0))
    one = d.agg(
        F.coalesce(F.sum(of("owner")), F.lit(0)).alias("entregas_total"), F.to_json(F.map_from_entries(F.transform(ranked, lambda x: F.struct(x["value"], -x["m"])))).alias("top5_produtos"), listed(AXES, axis).alias("entregas_por_eixo"),
        F.coalesce(F.round(F.avg(of("owner")), 1), F.lit(0.0)).alias("media_entregas_por_orgao"), F.coalesce(F.floor(F.median(of("owner"))).cast("long"), F.lit(0)).alias("mediana_entregas_por_orgao"),
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long")
    risk = r.agg(
        total("n").alias("riscos_total"), total("canonical").alias("riscos_canonicos"), whole(PROBABILITY, lambda i: total(f"p{i}")).alias("distribuicao_probabilidade"),
        whole(IMPACT, lambda i: total(f"i{i}")).alias("distribuicao_impacto"), listed(TREATMENT, lambda i: total(f"t{i}")).alias("distribuicao_tratamento"),
    )
    body = bodies.agg(F.count("*").alias("orgaos_total"), F.count("directive").alias("pdfs_diretivo"), F.count("delivery").alias("pdfs_entregas")).withColumn("pdfs_total", F.col("pdfs_diretivo") + F.col("pdfs_entregas"))
    failed = errors.where(F.col("kind").isin(*FAILED)).agg(F.count_distinct(F.struct("owner", "document")).alias("pdfs_escaneados_pendentes"))
    with_d, with_r = holders(d.where(by("owner")).select(F.col("value").alias("owner"))), holders(r.select(F.col("owner").cast("string").alias("owner")))
    out = one.select(F.lit(run_date).alias("data_execucao"), "*")
    for more in (risk, body, failed, with_d.withColumnRenamed("n", "entregas_orgaos"), with_r.withColumnRenamed("n", "riscos_orgaos")):
        out = out.withColumn("__one", F.lit(1)).join(more.withColumn("__one", F.lit(1)), "__one").drop("__one")  # a row each
    return out


def render(title: str, sections: Sequence[tuple[str, Mapping[str, object]]]) -> str:
    """A Markdown report of figures by section: whole numbers with points, fractions with a comma, in the order given."""

    def shown(v: object) -> str:
        if v is None:
            return "—"
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            return str(v)
        text = f"{v:,}" if isinstance(v, int) else f"{v:,.1f}"
        return text.translate(str.maketrans(",.", ".,"))

    lines = [f"# {title}", ""]
    for name, figures in sections:
        lines += [f"## {name}", "", *[f"- {k}: {shown(v)}" for k, v in figures.items()], ""]
    return "\n".join(lines)
