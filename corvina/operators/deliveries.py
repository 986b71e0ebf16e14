"""Deliveries of a catalogue's products in raw tables: columns by name, by a first row of names, or by what they hold.

All cells of all tables are matched against the catalogue once, as distinct texts. Which columns a table is read by
depends on the tables before it in its document, so it is decided by windows over one row per table; the cells are then read
with plain array expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.dates import parse_date
from corvina.functions.text import is_literal, let, norm_text
from corvina.functions.vocabularies import AXIS, PRODUCT, PRODUCT_AXIS, Vocabulary
from corvina.operators.canonical import match_fields
from corvina.operators.tables import DELIVERY_LITERALS, column_role, delivery_status, is_other
from corvina.sources.shared import kept, sized

# Roles of columns, texts that stand for nothing in them, reasons for review, and the places of a table without names.
ROLES = ("servico", "produto", "eixo", "data_pactuada", "data_entrega", "pactuado", "justificativa", "status")
NOTHING = ("nan", "none")
EMPTY = {"servico": ("servico/acao", "servico", "serviço /ação"), "eixo": ("eixo",)}
NAMES_OF_PRODUCT = ("produto", "produto ptd")
DATE_NAMES = ("dtpactuada", "dtentrega")
OTHER, RECOVERED, OTHER_PRODUCT, DOUBTFUL = "Outros", "recuperado de header multi-página", "produto Outros", "fuzzy="
BY_PLACE = {"servico": 0, "produto": 1, "eixo": 2}
#: Scores from which a cell names a product, needs no review, and names an axis.
NAMES, SURE, NAMES_AXIS = 0.85, 0.95, 0.80

KEY = ("doc", "page", "tbl")


def _matched_cells(grid: DataFrame, products: Vocabulary, axes: Vocabulary) -> DataFrame:
    """(doc, page, tbl, row, cells): every row with each cell's text, product, score, shown, other, axis and, in the first two, role and name; row -1 is the header."""
    every = F.concat(F.array(F.struct(F.lit(-1).alias("row"), F.col("header").alias("c"))), F.transform("rows", lambda r, i: F.struct(i.cast("int").alias("row"), r.alias("c"))))
    rows = grid.select(*KEY, F.inline(every))
    each = rows.select(*KEY, "row", F.posexplode("c").alias("col", "raw")).withColumn("raw", F.coalesce("raw", F.lit("")))
    texts = each.select("raw").distinct().select("raw", F.explode(F.array(F.lit("product"), F.lit("axis"))).alias("field"))
    found = match_fields(texts, "raw", {"product": products, "axis": axes})
    p = lambda c: F.max(F.when(F.col("field") == "product", F.col(c)))
    a = F.max(F.when((F.col("field") == "axis") & (F.col("score") >= NAMES_AXIS), F.col("match")))
    found = found.groupBy(F.col("raw").alias("text")).agg(p("match").alias("product"), p("score").alias("score"), p("shown").alias("shown"), a.alias("axis"))
    found = found.select("text", norm_text(F.col("text")).alias("clean"), "product", "score", "shown", is_other(F.col("text")).alias("other"), is_literal(F.col("text"), DELIVERY_LITERALS).alias("literal"), "axis", column_role(F.col("text")).alias("role"))
    found = sized(kept(found))
    cell = F.struct("col", F.col("clean").alias("text"), "product", "score", "shown", "other", "literal", "axis", F.when(F.col("row") <= 0, F.col("role")).alias("role"), F.when(F.col("row") < 0, F.col("raw")).alias("name"))
    return each.join(found, F.col("raw") == F.col("text")).groupBy(*KEY, "row").agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def _names(cell: Column) -> Column:
    return (cell["score"] >= NAMES) | cell["other"]


def _plans(rows: DataFrame) -> DataFrame:
    """How each table is read: (doc, page, tbl, at, skip, lift, roles), tables that nothing explains left out.

    A table is read by its own column names if they tell the product, or the service and one more. Else by those of the last such
    table of its document; and where none stands before it, by the names in its first row, or by the first cell that names a
    product, its neighbours being service and axis. A row that names a product holds no names of columns, though products
    have words in common with them. at has the place of each role; skip drops the first row; lift says that the
    names are a delivery that a page break put there.
    """
    hit = F.min(F.when(F.col("row") >= 0, F.get(F.transform(F.filter("cells", _names), lambda c: F.struct(F.col("row"), c["col"].alias("col"))), F.lit(0)))).alias("hit")
    data = lambda row, name: F.coalesce(F.bool_or(F.when(F.col("row") == row, F.exists("cells", _names))), F.lit(False)).alias(name)
    of_row = lambda row, field, name: F.coalesce(F.any_value(F.when(F.col("row") == row, F.col(f"cells.{field}")), ignoreNulls=True), F.array().cast("array<string>")).alias(name)
    g = rows.groupBy(*KEY).agg(hit, data(-1, "data_header"), data(0, "data_first"), of_row(-1, "name", "names"), of_row(-1, "role", "own"), of_row(0, "role", "below"))
    g = g.withColumn("k", F.struct(*KEY))
    names = F.col("names")
    # A role's column is known by its place and by its name, since later tables are looked up by name.
    column = lambda place: F.struct(place.cast("int").alias("place"), F.get(names, place.cast("int")).alias("name"))
    of = lambda found, r: F.when(F.array_position(found, r) > 0, column(F.array_position(found, r) - 1))
    mapped = lambda found: F.struct(*[of(F.col(found), r).alias(r) for r in ROLES])
    has = lambda found, r: F.array_contains(F.transform(found, lambda x: F.coalesce(x, F.lit(""))), r)
    n = F.size(F.array_distinct(F.array_compact("own")))
    named = (has("own", "produto") | (has("own", "servico") & (n >= 2))) & ~F.col("data_header")
    col, width = F.col("hit.col"), F.size("names")
    by_value = F.struct(*[F.when({"produto": F.lit(True), "servico": col > 0, "eixo": col + 1 < width}.get(r, F.lit(False)), column({"servico": col - 1, "eixo": col + 1}.get(r, col))).alias(r) for r in ROLES])
    below = (F.size(F.array_compact("below")) > 0) & ~F.col("data_first")
    g = g.withColumn("named", named).withColumn("explains", F.col("named") | below | F.col("hit").isNotNull())
    order = Window.partitionBy("doc").orderBy("page", "tbl")
    before, now = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("first", F.col("explains") & ~F.coalesce(F.max("explains").over(before), F.lit(False)))
    own = F.when(F.col("named"), mapped("own")).when(F.col("first") & below, mapped("below")).when(F.col("first"), by_value)
    g = g.withColumn("set", own).withColumn("map", F.last("set", ignorenulls=True).over(now)).where("map is not null")
    # A table goes on with another's columns where the product's name isn't among its own.
    goes_on = F.col("map.produto").isNotNull() & ~F.array_contains(names, F.col("map.produto.name"))
    place = lambda r: F.when(F.col(f"map.{r}").isNotNull() & F.array_contains(names, F.col(f"map.{r}.name")), F.array_position(names, F.col(f"map.{r}.name")) - 1)
    usual = {r: F.lit(i) for r, i in BY_PLACE.items()} | {"data_pactuada": F.when(width >= 5, 4).when(width >= 4, 3)}
    at = F.struct(*[(F.when(F.col("named") | F.col("set").isNotNull(), F.col(f"map.{r}.place")).when(F.col("goes_on"), F.coalesce(usual[r], place(r)) if r in usual else place(r)).otherwise(place(r))).cast("int").alias(r) for r in ROLES])
    known = F.array_compact(F.array(*[F.when(F.col(f"map.{r}").isNotNull(), r) for r in ROLES]))
    lift = ~F.col("named") & F.col("set").isNull() & (F.size(known) == width)
    return g.withColumn("goes_on", goes_on).select("k", at.alias("at"), (F.col("set").isNotNull() & ~F.col("named") & below).alias("skip"), lift.alias("lift"), known.alias("roles"))


def catalogue_deliveries(grid: DataFrame, products: Vocabulary = PRODUCT, axes: Vocabulary = AXIS) -> DataFrame:
    """(doc, page, tbl, row, service, original, product, axis_original, axis, due, delivered, agreed, reason, state, score, confidence, needs_review, review_reason) of all rows that name a product.

    ``grid`` has one row per table (doc, page, tbl, header, rows); tables of fewer than three columns or without rows say
    nothing. A row counts if its product cell names one from 0.85 on or says "other"; where that cell is blank, the row's first
    cell that does. Names of columns that stand among the rows are left out. The axis is the product's own, else what the axis cell
    names from 0.80 on. A header that is a delivery, left by a page break, is recovered as row -1 with medium confidence, for
    review. Other products than those at 0.95 are reviewed. Null cells are blank, a null document is one document.
    """
    g = grid.where((F.size("header") >= 3) & (F.size("rows") > 0)).select(*KEY, "header", "rows")
    rows = kept(_matched_cells(g, products, axes))
    plans = _plans(rows)
    # A table is small in its file and large once unpacked: its rows meet by exchange, never by a broadcast.
    r = rows.withColumn("k", F.struct(*KEY)).join(plans.hint("merge"), "k").drop("k")
    r = r.where((F.col("row") >= F.when(F.col("skip"), 1).otherwise(0)) | ((F.col("row") == -1) & F.col("lift")))
    nothing = lambda c, also=(): let(F.coalesce(c["text"], F.lit("")), lambda t: F.when(F.lower(t).isin(*NOTHING, *also), "").otherwise(t))
    cell = lambda role: F.get("cells", F.col(f"at.{role}"))
    head = F.col("row") == -1
    place = lambda i: F.get("cells", F.lit(i))
    own = F.when(head, place(1)).otherwise(cell("produto"))
    blank = F.coalesce(F.lower(own["text"]).isin("", *NOTHING, *NAMES_OF_PRODUCT), F.lit(True))
    r = r.withColumn("p", F.when(~head & blank, F.get(F.filter("cells", _names), F.lit(0))).otherwise(own))
    whole = F.lower(F.col("cells")[0]["text"])
    r = r.where(F.col("p").isNotNull() & _names(F.col("p")) & F.when(head, ~whole.isin("", *NOTHING)).otherwise(~F.col("p.literal")))
    product = F.when(F.col("p.score") >= NAMES, F.col("p.product")).otherwise(OTHER)
    axis_cell = F.when(head, place(2)).otherwise(cell("eixo"))
    own_axis = F.element_at(F.create_map(*[F.lit(v) for pair in PRODUCT_AXIS.items() for v in pair]), F.col("product"))
    texts = {n: F.when(~head, nothing(cell(role), DATE_NAMES)) for n, role in (("delivered", "data_entrega"), ("agreed", "pactuado"), ("reason", "justificativa"), ("status", "status"))}
    service = F.when(head, place(0)["text"]).otherwise(nothing(cell("servico"), EMPTY["servico"]))
    due = F.when(head, F.coalesce(place(4)["text"], F.lit(""))).otherwise(nothing(cell("data_pactuada"), DATE_NAMES))
    r = r.select(*KEY, "row", F.coalesce(F.substring(service, 1, 250), F.lit("")).alias("service"), F.substring("p.text", 1, 250).alias("original"), product.alias("product"), F.when(head, F.substring(place(2)["text"], 1, 100)).otherwise(nothing(axis_cell, EMPTY["eixo"])).alias("axis_original"), axis_cell["axis"].alias("named_axis"), due.alias("due"), *[v.alias(n) for n, v in texts.items()], "roles", "p")
    date = lambda c: F.when(F.coalesce(c, F.lit("")) != "", parse_date(F.col(c)))
    full = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.col(c))
    score, other = F.col("p.score"), F.col("p.other")
    state = F.when(head, "pactuada").otherwise(delivery_status(full("status"), F.col("roles")))
    return r.select(
        *KEY, "row", "service", "original", "product", F.coalesce("axis_original", F.lit("")).alias("axis_original"), F.coalesce(own_axis, F.when(F.coalesce("axis_original", F.lit("")) != "", F.col("named_axis")), F.lit("")).alias("axis"),
        date("due").alias("due"), date("delivered").alias("delivered"), full("agreed").alias("agreed"), F.substring(full("reason"), 1, 500).alias("reason"), state.alias("state"), F.round(score, 3).alias("score"),
        F.when(head, "medium").when(score >= SURE, "high").when(score >= NAMES, "medium").otherwise("low").alias("confidence"), (head | (score < SURE) | other).alias("needs_review"),
        F.when(head, RECOVERED).when(other, OTHER_PRODUCT).when(score < SURE, F.concat(F.lit(DOUBTFUL), "p.shown")).alias("review_reason"),
    )
