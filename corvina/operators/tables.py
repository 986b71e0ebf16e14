"""Raw tables of documents: what they are, how broken ones are mended, what they say.

A grid row is one table: doc, page, tbl, header ARRAY<STRING>, rows ARRAY<ARRAY<STRING>>. What
one table says about the next, such as the columns of a table that goes on over a page, is a window
over the tables of a document; nothing is kept in Python between rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvina.functions.dates import parse_date
from corvina.functions import text as X
from corvina.functions.text import header_key, is_fragment, is_literal, let, norm_text, squeeze, strip_accents
from corvina.functions.vocabularies import PRODUCT_AXIS, Vocabulary
from corvina.operators.canonical import best_ratio, match_fields, match_values
from corvina.sources.shared import kept, sized

# The words by which the tables of such documents are told apart.
RISK_WORDS = ("risco", "probabilidade", "impacto", "tratamento", "ocorrer")
RISK_OTHER = ("evento", "classificacao", "severidade", "resposta", "acao", "acoes", "id do risco", "descricao do risco", "opcao de tratamento")
OWNER_WORDS = ("orgao", "ministerio", "secretaria", "sigla", "cnpj", "responsavel", "gestor", "dirigente", "titular", "instituicao", "vinculacao")
SIGN_WORDS = ("assinatura", "assinado", "data", "nome", "cargo", "cpf")
LEVELS = ("raro", "pouco provavel", "provavel", "muito provavel", "praticamente certo", "baixo", "medio", "alto", "muito alto", "baixa", "media", "alta")
LEVELS_AND_ACTIONS = (*LEVELS, "muito baixo", "mitigar", "eliminar", "transferir", "aceitar")
SUBHEADERS = ("certo]", "certo ]", "ocorrer", "muito alto]", "muito alto ]", "tratamento do risco", "escolher entre")
GENERIC_HEADERS = ("escolher entre", "certo]", "certo ]", "muito alto]", "muito alto ]", "ocorrer")
RISK_LITERALS = ("risco", "probabilidade", "impacto", "tratamento", "acoes", "acao", "probabilidade de ocorrencia", "nivel de impacto", "id risco", "id do risco", "id")
FIELD_LITERALS = ("probabilidade", "impacto", "tratamento", "risco", "probabilidade de ocorrencia", "nivel de impacto")
DELIVERY_LITERALS = ("servico", "servico/acao", "acao", "produto", "produto ptd", "eixo", "data pactuada", "data entrega", "area responsavel", "id", "id entrega")
ROLE_WORDS = {
    "risk": ("risco", "evento", "descricao do risco", "descricao"),
    "probability": ("probabilidade", "probabilidade de ocorrer", "prob", "classificacao de probabilidade"),
    "impact": ("impacto", "severidade", "classificacao de impacto"),
    "treatment": ("opcao de tratamento", "tratamento", "resposta", "tipo de tratamento", "estrategia"),
    "actions": ("acoes de tratamento", "descrever acoes", "acoes", "acao", "medidas", "plano de acao"),
}
ID_HEADERS = ("id do risco", "id risco", "id", "n", "no", "num", "numero", "codigo", "cod")
OTHER = ("outros", "outro", "outros -", "outros –")

def contains_any(c: Column, words) -> Column:
    return let(c, lambda x: X.contains_any(x, words))


def hits(c: Column, words) -> Column:
    return let(c, lambda x: X.hits(x, words))


def _cells(c: Column, key=header_key) -> Column:
    return F.transform(c, lambda x: key(F.coalesce(x, F.lit(""))))


def _combined() -> Column:
    first = F.coalesce(F.get(F.col("rows"), F.lit(0)), F.array().cast("array<string>"))
    return F.array_join(F.concat(_cells(F.col("header")), _cells(first)), " ")


def _all_text() -> Column:
    return strip_accents(F.lower(F.array_join(F.flatten(F.col("rows")), " ", "")))


def directive_kind() -> Column:
    """risk_table, organ_info, signature or unknown, by words in the header and the first row."""
    n = F.size(F.col("header"))
    few = n.between(3, 8)
    return let(_combined(), lambda text: _kind_by_words(text, n, few))


def _kind_by_words(text: Column, n: Column, few: Column) -> Column:
    hits = X.hits
    risk = few & ((hits(text, RISK_WORDS) >= 2) | ((hits(text, RISK_WORDS) >= 1) & (hits(text, RISK_OTHER) >= 1)))
    return F.when(n == 0, "unknown").when(risk, "risk_table").when(hits(text, OWNER_WORDS) >= 2, "organ_info").when((hits(text, SIGN_WORDS) >= 2) & (n <= 4), "signature").otherwise("unknown")


def delivery_kind() -> Column:
    """cancelled, done, agreed or unknown; a table without rows is unknown."""
    text = _combined()
    tight = F.replace(text, F.lit(" "), F.lit(""))
    done = tight.contains("dtentrega") | contains_any(text, ("data entrega", "data de entrega", "pactuado?", "pactuado ?"))
    agreed = tight.contains("dtpactuada") | text.contains("data pactuada")
    return F.when(F.size(F.col("rows")) == 0, "unknown").when(text.contains("justificativa"), "cancelled").when(done, "done").when(agreed, "agreed").otherwise("unknown")


def header_is_data() -> Column:
    """Whether the first risk was taken for the header."""
    a, b = header_key(F.get(F.col("header"), F.lit(0))), header_key(F.get(F.col("header"), F.lit(1)))
    long_ = let(a, lambda x: (F.length(x) >= 10) & ~x.startswith("risco") & ~x.startswith("col"))
    return (F.size(F.col("header")) >= 4) & long_ & contains_any(b, LEVELS)


def has_risk_data() -> Column:
    """Whether the rows hold two or more level or treatment words."""
    return (F.size(F.col("rows")) > 0) & (F.size(F.col("header")) >= 4) & (hits(_all_text(), LEVELS_AND_ACTIONS) >= 2)


def is_subheader(cells: Column) -> Column:
    """Whether a row explains how to fill the columns."""
    return contains_any(strip_accents(F.lower(F.array_join(cells, " ", ""))), SUBHEADERS)


def has_orphan_header() -> Column:
    """Whether the header is of a risk table's width and generic."""
    generic = F.size(F.filter(_cells(F.col("header")), lambda h: (h.startswith("col") & (F.length(h) <= 5)) | contains_any(h, GENERIC_HEADERS)))
    return F.size(F.col("header")).between(4, 8) & (generic >= F.greatest(F.lit(2), F.floor(F.size(F.col("header")) / 2)))


def is_orphan() -> Column:
    """Risk data under generic headers, without a table that introduced it."""
    return has_orphan_header() & has_risk_data()


def column_role(c: Column) -> Column:
    """A delivery column's role by its name; exact names go before parts of names."""
    return let(header_key(c), lambda k: _role_by_name(k, squeeze(k), F.replace(k, F.lit(" "), F.lit(""))))


def _role_by_name(k: Column, s: Column, tight: Column) -> Column:
    contains_any = X.contains_any
    return (
        F.when(s.isin("status", "situacao"), "status")
        .when(s.isin("pactuado", "pactuado?", "entregue", "entregue?"), "pactuado")
        .when((s == "justificativa") | (k.contains("motivo") & k.contains("cancel")), "justificativa")
        .when(contains_any(k, ("servico", "acao")), "servico")
        .when(s.isin("produto", "produto ptd", "entrega"), "produto")
        .when(k.contains("eixo"), "eixo")
        .when(tight.contains("dtpactuada") | contains_any(k, ("data pactuada", "prazo")), "data_pactuada")
        .when(tight.contains("dtentrega") | contains_any(k, ("data entrega", "data conclusao")), "data_entrega")
    )


def delivery_status(status: Column, roles: Column) -> Column:
    """concluida, cancelada or pactuada: by the row's status where it is clear, else by the table's roles."""
    has = lambda r: F.array_contains(roles, r)
    own = let(F.lower(norm_text(status)), lambda s: F.when(s.contains("conclu") | s.isin("sim", "entregue", "finalizada"), "concluida").when(s.contains("cancel") | s.isin("nao", "não"), "cancelada").when(s.contains("pactuada") | (s == "em andamento"), "pactuada"))
    return F.coalesce(own, F.when(has("data_entrega") | has("pactuado"), "concluida").when(has("justificativa"), "cancelada").otherwise("pactuada"))


def is_other(c: Column) -> Column:
    """Whether the text says "other" in one of its spellings."""
    return F.lower(norm_text(c)).isin(*OTHER)


def risk_roles(headers: DataFrame, col: str = "header") -> DataFrame:
    """(header, at): for each distinct header the places of risk, probability, impact, treatment and actions, null for none.

    Words inside a name count first, by their share of it, then similar wording from 0.65 on; ids are no risks. Roles
    without a name take their usual place, one further on behind an id column, if no other role has it.
    """
    names = headers.select(F.col(col).alias("header")).distinct().select("header", F.posexplode(_cells(F.col("header"))).alias("i", "name"))
    names = names.withColumn("is_id", F.col("name").isin(*ID_HEADERS) | F.col("name").startswith("id "))
    each = names.select("*", F.posexplode(F.array(*map(F.lit, ROLE_WORDS))).alias("place", "role"))
    length = F.greatest(F.length("name"), F.lit(1))
    inside = F.coalesce(*[F.when(F.col("role") == r, F.array_max(F.transform(F.filter(F.array(*map(F.lit, w)), lambda x: F.col("name").contains(x)), lambda x: F.greatest(F.length(x) / length, F.lit(0.85))))) for r, w in ROLE_WORDS.items()])
    similar = best_ratio(F.col("role"), F.when(F.col("name") != "", F.col("name")), ROLE_WORDS)
    each = each.withColumn("inside", inside).withColumn("similar", similar["score"])
    no_risk = (F.col("role") == "risk") & F.col("is_id")
    each = each.withColumns({"inside": F.when(~no_risk, F.col("inside")), "similar": F.when(~no_risk & (F.col("similar") >= 0.65), F.col("similar"))})
    columns = F.array_sort(F.collect_list(F.struct("i", "inside", "similar")))
    state = "struct<best:int,score:double>"
    at = lambda best, score: F.struct(best.alias("best"), score.alias("score")).cast(state)

    def better(s: Column, x: Column) -> Column:
        return F.when(F.coalesce(x["inside"], F.lit(0.0)) > s["score"], at(x["i"], x["inside"])).when(s["best"].isNull() & x["similar"].isNotNull(), at(x["i"], x["similar"])).otherwise(s)

    by_role = each.groupBy("header", "place").agg(F.aggregate(columns, at(F.lit(None), F.lit(0.0)), better)["best"].alias("best"), F.max_by("name", -F.col("i")).alias("first"), F.collect_set(F.when(F.col("is_id"), F.col("i"))).alias("ids"))
    found = by_role.groupBy("header").agg(F.first("first").alias("first"), F.first("ids").alias("ids"), F.transform(F.array_sort(F.collect_list(F.struct("place", "best"))), lambda x: x["best"]).alias("best"))
    n = F.size("header")
    step = F.when((n >= 6) & (F.array_contains("ids", 0) | (F.col("first") == "col0")), 1).otherwise(0)

    def usual(out: Column, k: Column) -> Column:
        own, place = F.get(F.col("best"), k), k + step
        free = own.isNull() & (place < n) & ~F.array_contains("ids", place) & ~F.exists(F.concat(F.col("best"), out), lambda x: F.coalesce(x == place, F.lit(False)))
        return F.concat(out, F.array(F.when(free, place).otherwise(own)))

    places = F.aggregate(F.sequence(F.lit(0), F.lit(len(ROLE_WORDS) - 1)), F.array().cast("array<int>"), usual)
    return found.select("header", places.alias("p")).select("header", F.struct(*[F.get("p", F.lit(k)).alias(r) for k, r in enumerate(ROLE_WORDS)]).alias("at"))


def long_rows(grid: DataFrame) -> DataFrame:
    """(doc, page, tbl, header, row, cells): one row for each row of each table."""
    return grid.select("doc", "page", "tbl", "header", F.posexplode("rows").alias("row", "cells"))


def consolidate(rows: DataFrame) -> DataFrame:
    """``long_rows`` with cells broken over several rows joined again.

    Where at least 3 but fewer than 0.4 of a table's rows of 4 or more cells have an id, the rows from one id to the next
    become one; the first takes a row before it that has text but no id. Parts are joined by a blank, by " | " where one is a bullet or several hold a
    semicolon. Other tables stay as they are.
    """
    table = ["doc", "page", "tbl"]
    text = lambda c: ~F.lower(squeeze(F.coalesce(c, F.lit("")))).isin("", "nan", "none")
    w = Window.partitionBy(*table)
    r = rows.withColumn("is_id", text(F.get("cells", F.lit(0))))
    r = r.withColumn("ids", F.count_if("is_id").over(w)).withColumn("n", F.count("*").over(w))
    r = r.withColumn("broken", (F.size("header") >= 4) & (F.col("ids") >= 3) & (F.col("ids") < 0.4 * F.col("n")))
    whole = r.where("not broken").select(*table, "header", "row", "cells")
    by = w.orderBy("row")
    b = r.where("broken").withColumn("block", F.count_if("is_id").over(by.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next_is_id", F.lead("is_id").over(by))
    pulled = (F.col("block") == 0) & F.col("next_is_id") & text(F.get("cells", F.lit(1)))
    b = b.withColumn("block", F.when(pulled, 1).otherwise(F.col("block"))).where("block > 0")
    cells = b.select(*table, "header", "block", "row", F.posexplode("cells").alias("i", "v")).withColumn("v", squeeze(F.coalesce("v", F.lit(""))))
    parts = F.transform(F.array_sort(F.collect_list(F.when(text(F.col("v")), F.struct("row", "v")))), lambda x: x["v"])
    one = cells.groupBy(*table, "header", "block", "i").agg(parts.alias("p"), F.min("row").alias("row"))
    bars = F.exists("p", lambda x: x.rlike(r"^[-•*]")) | (F.exists("p", lambda x: x.contains(";")) & (F.size("p") > 1))
    one = one.withColumn("v", F.when(bars, F.array_join("p", " | ")).otherwise(F.array_join("p", " ")))
    done = one.groupBy(*table, "header", "block").agg(F.min("row").alias("row"), F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("cells"))
    return whole.unionByName(done.select(*table, "header", "row", "cells"))


def carry_tables(grid: DataFrame) -> DataFrame:
    """``grid`` with how each table is read: header, data_header, continuation, orphan or null, and carried_header.

    A continuation has as many columns as the last table read as risks before it in its document, and risk data;
    carried_header is the last proper header so far.
    """
    by = Window.partitionBy("doc").orderBy("page", "tbl")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    g = grid.withColumn("__h", directive_kind() == "risk_table").withColumn("__d", ~F.col("__h") & header_is_data())
    # Below the window the words of a table are looked up once, however often ``how`` is asked for above it.
    g = g.withColumn("__r", ~F.col("__h") & ~F.col("__d") & has_risk_data()).withColumn("__o", F.col("__r") & has_orphan_header())
    sets = F.when((F.size(F.col("header")) >= 4) & (F.col("__h") | F.col("__d") | F.col("__o")), F.size(F.col("header")))
    g = g.withColumn("__n", F.last(sets, ignorenulls=True).over(before))
    goes_on = (F.col("__n") == F.size(F.col("header"))) & F.col("__r")
    how = F.when(F.size(F.col("header")) < 4, None).when(F.col("__h"), "header").when(F.col("__d"), "data_header").when(goes_on, "continuation").when(F.col("__o"), "orphan")
    g = g.withColumn("how", how).withColumn("carried_header", F.last(F.when(F.col("how") == "header", F.col("header")), ignorenulls=True).over(by))
    return g.drop("__h", "__d", "__r", "__o", "__n")


def risk_rows(grid: DataFrame) -> DataFrame:
    """(doc, page, tbl, row, risk, probability, impact, treatment, actions, source) of all tables read as risks.

    Rows that explain or repeat the header, and rows without risk, probability and impact, are left out. A header that
    is data gives its own row (row -1, source data_header). nan and none are empty.
    """
    clean = lambda c: let(norm_text(c), lambda x: F.when(F.lower(x).isin("nan", "none"), F.lit("")).otherwise(x))
    g = carry_tables(grid).where("how is not null")
    # One row for each table, its parts unpacked at once: the tables are classified a single time.
    roles = risk_roles(g.where("how = 'header'")).withColumnRenamed("header", "named")
    g = g.join(roles, (F.col("how") == "header") & (F.col("header") == F.col("named")), "left").drop("named")
    short = F.forall(F.slice("rows", 1, 3), lambda r: F.length(squeeze(F.coalesce(F.get(r, F.lit(0)), F.lit("")))) <= 3)
    body = F.transform(F.col("rows"), lambda r, i: F.struct(i.alias("row"), r.alias("cells")))
    lifted = F.array(F.struct(F.lit(-1).alias("row"), F.col("header").alias("cells")))
    every = F.when(F.col("how") == "data_header", F.concat(lifted, body)).otherwise(body)
    rows = g.select("doc", "page", "tbl", "how", "at", F.size("header").alias("ncols"), (short & (F.size("header") > 5)).alias("step"), F.inline(every)).withColumn("step", F.col("step") & (F.col("row") >= 0))
    place = {r: F.coalesce(F.col(f"at.{r}"), F.when(F.col("how") != "header", F.lit(i) + F.coalesce(F.col("step"), F.lit(False)).cast("int"))) for i, r in enumerate(ROLE_WORDS)}
    cells = let(F.transform(F.array(*[F.get("cells", p) for p in place.values()]), clean), lambda v: F.struct(*[F.get(v, F.lit(i)).alias(r) for i, r in enumerate(place)]))
    # Unpacked as a generated row, the cells are computed once for all tests below.
    out = rows.where(~is_subheader(F.col("cells"))).select("doc", "page", "tbl", "row", F.col("how").alias("source"), F.inline(F.array(cells)))
    literal = F.lit(False)
    for r in ("risk", "probability", "impact", "treatment"):
        literal = literal | is_literal(F.col(r), RISK_LITERALS)
    return out.where(~((F.col("risk") == "") & (F.col("probability") == "") & (F.col("impact") == ""))).where(~literal)


def swap_columns(df: DataFrame, a: str, b: str, va: Vocabulary, vb: Vocabulary) -> DataFrame:
    """``df`` with two columns exchanged where both fit badly in place and well crossed, and a flag ``swapped``."""
    # The rows may be dear to compute, and are read twice.
    df = kept(df)
    texts = df.select(F.explode(F.array(a, b)).alias("t")).distinct()
    each = texts.select("t", F.explode(F.array(F.lit("sa"), F.lit("sb"))).alias("field"))
    score = lambda f: F.max(F.when(F.col("field") == f, F.col("score"))).alias(f)
    fits = sized(kept(match_fields(each, "t", {"sa": va, "sb": vb}).groupBy("t").agg(score("sa"), score("sb"))))
    out = df
    for col in (a, b):
        out = out.join(fits.toDF("__t", f"__{col}_{va.name}", f"__{col}_{vb.name}"), F.col(col).eqNullSafe(F.col("__t")), "left").drop("__t")
    at = lambda col, v: F.col(f"__{col}_{v.name}")
    bad = (at(a, va) < 0.70) | (at(b, vb) < 0.70)
    swap = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "") & bad & (at(a, vb) >= 0.85) & (at(b, va) >= 0.85)
    out = out.withColumn("swapped", F.coalesce(swap, F.lit(False)))
    return out.withColumns({a: F.when(F.col("swapped"), F.col(b)).otherwise(F.col(a)), b: F.when(F.col("swapped"), F.col(a)).otherwise(F.col(b))}).drop(*[f"__{c}_{v.name}" for c in (a, b) for v in (va, vb)])


def audit(df: DataFrame, fields: dict[str, tuple[Vocabulary, tuple[Vocabulary, ...]]], order: str) -> DataFrame:
    """(order, field, value, category) of suspicious values: header_captured, fragment, column_bleed or column_shift.

    The first that holds counts. A bleed is longer than 30 characters and fits no term; a shift fits another
    vocabulary at 0.85 and by over 0.10 better than its own. Scores come from the terms alone.
    """
    parts = []
    for name, (own, others) in fields.items():
        rows = df.select(order, F.lit(name).alias("field"), F.col(name).alias("value")).where(F.coalesce(name, F.lit("")) != "")
        for i, v in enumerate((own, *others)):
            bare = Vocabulary(v.name, v.terms)
            s = match_values(rows, "value", bare).select(F.col("value").alias("__v"), F.col("score").alias(f"s{i}"))
            rows = rows.join(s, F.col("value") == F.col("__v"), "left").drop("__v")
        shift = [F.when((F.col("s0") < 0.85) & (F.col(f"s{i}") >= 0.85) & (F.col(f"s{i}") > F.col("s0") + 0.10), v.name) for i, v in enumerate(others, 1)]
        found = F.coalesce(*shift) if shift else F.lit(None).cast("string")
        kind = F.when(is_literal(F.col("value"), FIELD_LITERALS), "header_captured").when(is_fragment(F.col("value")), "fragment").when((F.length("value") > 30) & (F.col("s0") < 0.70), "column_bleed").when(found.isNotNull(), "column_shift")
        parts.append(rows.select(order, "field", "value", kind.alias("category"), found.alias("fits")).where("category is not null"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("fits", F.when(F.col("category") == "column_shift", F.col("fits")))


#: How the audited fields are called in reasons for review.
LABELS = {"probability": "probabilidade", "impact": "impacto", "treatment": "tratamento"}


def flag_audited(df: DataFrame, fields: dict[str, tuple[Vocabulary, tuple[Vocabulary, ...]]], order: str) -> tuple[DataFrame, DataFrame]:
    """(df under review where ``audit`` finds something, (category, n) of what it found).

    A suspicious row gets needs_review, low confidence and, appended to its review_reason, a reason for each field in the order of
    ``fields``. Other rows keep what they have: false, null and high where ``df`` lacks the columns.
    """
    found = audit(df, fields, order)
    label = lambda c: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair]), c), c)
    kind, start = F.col("category"), F.substring("value", 1, 30)
    text = F.when(kind == "header_captured", F.concat(F.lit("header capturado ('"), start, F.lit("')"))).when(kind == "fragment", F.concat(F.lit("fragmento ('"), start, F.lit("')")))
    text = text.when(kind == "column_bleed", F.concat(F.lit("bleed de coluna ("), F.length("value").cast("string"), F.lit(" chars)"))).otherwise(F.concat(F.lit("column-shift (casa em '"), label(F.col("fits")), F.lit("')")))
    place = F.array_position(F.array(*map(F.lit, fields)), F.col("field"))
    why = found.groupBy(F.col(order).alias("__row")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place.alias("i"), F.concat(label(F.col("field")), F.lit(": "), text).alias("r")))), lambda x: x["r"]), "; ").alias("__why"))
    have = set(df.columns)
    old = {"needs_review": F.lit(False), "review_reason": F.lit(None).cast("string"), "confidence": F.lit("high")}
    out = df.withColumns({c: v for c, v in old.items() if c not in have}).join(why, F.col(order) == F.col("__row"), "left")
    hit, before = F.col("__why").isNotNull(), F.trim(F.coalesce("review_reason", F.lit("")))
    out = out.withColumns({
        "needs_review": F.col("needs_review") | hit,
        "review_reason": F.when(~hit, F.col("review_reason")).when(before == "", F.col("__why")).otherwise(F.concat(before, F.lit("; "), F.col("__why"))),
        "confidence": F.when(hit, "low").otherwise(F.col("confidence")),
    }).drop("__row", "__why")
    return out, found.groupBy("category").agg(F.count("*").alias("n"))


def action_list(lines: DataFrame, anchor: str) -> DataFrame:
    """(doc, number, action) of the numbered lines after the first line that matches the anchor, until a line without a number once more than 3 were found."""
    by = Window.partitionBy("doc").orderBy("page", "line").rowsBetween(Window.unboundedPreceding, 0)
    m = r"^\s*(\d{1,2})\s*[.\-)]\s*(.+)"
    x = lines.withColumn("__a", F.max(F.col("text").rlike(anchor)).over(by)).where("__a").withColumn("__n", F.col("text").rlike(m))
    x = x.withColumn("__k", F.count_if("__n").over(by)).withColumn("__stop", F.max(~F.col("__n") & ~F.substring(squeeze(F.col("text")), 1, 1).rlike(r"\d") & (F.col("__k") > 3)).over(by))
    got = x.where("__n and not __stop").select("doc", "page", "line", F.regexp_extract("text", m, 1).alias("number"), squeeze(F.regexp_extract("text", m, 2)).alias("action"))
    return got.groupBy("doc", "number").agg(F.max_by("action", F.struct("page", "line")).alias("action"))


def resolve_refs(c: Column, actions: Column) -> Column:
    """Text of numbers, such as "1, 2, 9", as "1. First | 2. Second" by a map; other text, and numbers the map lacks, stay."""
    tokens = F.split(squeeze(c), r"[,;\s]+")
    share = F.size(F.filter(tokens, lambda t: t.rlike(r"^\d+$"))) / F.greatest(F.size(tokens), F.lit(1))
    refs = F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1))
    got = F.filter(F.transform(refs, lambda r: F.concat(r, F.lit(". "), F.element_at(actions, r))), lambda x: x.isNotNull())
    return F.when((share >= 0.5) & (F.size(got) > 0), F.array_join(got, " | ")).otherwise(c)


def text_deliveries(lines: DataFrame, products: Vocabulary, axes: Vocabulary) -> DataFrame:
    """(doc, page, line, service, original, product, axis, due, score, confidence, needs_review, review_reason) of the lines that name a product at 0.85 or "other".

    The line before is the service unless it names a product or axis, is short, or a month. The axis is the
    product's own, else what the next line names; the first date within four lines is the due date. Only a product at 0.95 that
    isn't "other" needs no review.
    """
    by = Window.partitionBy("doc", "page").orderBy("line")
    x = lines.withColumn("text", F.trim("text")).where("text != ''")
    p = match_values(x, "text", products).select(F.col("text").alias("__p"), F.col("match").alias("product"), F.col("score").alias("p_score"))
    a = match_values(x, "text", axes).select(F.col("text").alias("__x"), F.col("match").alias("axis"), F.col("score").alias("a_score"))
    x = x.join(p, F.col("text") == F.col("__p")).join(a, F.col("text") == F.col("__x")).drop("__p", "__x")
    months = "jan|fev|mar|abr|mai|jun|jul|ago|set|out|nov|dez"
    date = F.when(F.lower("text").rlike(rf"^({months})[-/]\d{{2,4}}$") | F.col("text").rlike(r"^\d{2}/\d{2,4}$"), F.col("text"))
    usable = (F.col("p_score") < 0.80) & (F.col("a_score") < 0.80) & (F.length("text") > 5) & ~F.lower("text").rlike(f"^({months})")
    x = x.withColumn("__service", F.lag(F.when(usable, F.substring("text", 1, 250))).over(by)).withColumn("__axis", F.lead(F.when(F.col("a_score") >= 0.80, F.col("axis"))).over(by)).withColumn("__date", date)
    x = x.withColumn("__due", F.first("__date", ignorenulls=True).over(by.rowsBetween(1, 4)))
    named = F.col("p_score") >= 0.85
    other = is_other(F.col("text"))
    product = F.when(named, F.col("product")).otherwise("Outros")
    own = F.element_at(F.create_map(*[F.lit(v) for pair in PRODUCT_AXIS.items() for v in pair]), product)
    return x.where(named | other).select(
        "doc", "page", "line", F.coalesce("__service", F.lit("")).alias("service"), F.substring("text", 1, 250).alias("original"), product.alias("product"), F.coalesce(own, "__axis", F.lit("")).alias("axis"),
        F.when(F.col("__due").isNotNull(), parse_date(F.col("__due"))).alias("due"), F.round("p_score", 3).alias("score"),
        F.when(F.col("p_score") >= 0.95, "high").when(named, "medium").otherwise("low").alias("confidence"), ((F.col("p_score") < 0.95) | other).alias("needs_review"), F.when(other, "produto Outros").alias("review_reason"),
    )


def table_deliveries(grid: DataFrame) -> DataFrame:
    """(doc, page, tbl, row, product, service, axis, due, delivered, agreed, reason, status, state) of delivery tables.

    Columns get their roles by name; a table without named columns takes the roles of the last one in its
    document that had as many. Rows without a product and repeated headers are left out.
    """
    by = Window.partitionBy("doc").orderBy("page", "tbl").rowsBetween(Window.unboundedPreceding, 0)
    roles = F.transform(F.col("header"), column_role)
    own = (F.array_contains(F.transform(roles, lambda r: F.coalesce(r, F.lit(""))), "produto")) | (F.size(F.array_compact(roles)) >= 2)
    g = grid.where(F.size(F.col("header")) >= 3).withColumn("__r", F.when(own, roles)).withColumn("__c", F.last("__r", ignorenulls=True).over(by))
    g = g.where(F.col("__c").isNotNull() & (F.col("__r").isNotNull() | (F.size("__c") == F.size("header"))))
    lifted = g.where("__r is null").select("doc", "page", "tbl", "__c", F.lit(-1).alias("row"), F.col("header").alias("cells"))
    rows = g.select("doc", "page", "tbl", "__c", F.posexplode("rows").alias("row", "cells")).unionByName(lifted)
    at = lambda role: norm_text(F.get("cells", F.when(F.array_position("__c", role) > 0, (F.array_position("__c", role) - 1).cast("int"))))
    clean = lambda c: F.when(F.lower(c).isin("nan", "none", "dtpactuada", "dtentrega"), F.lit("")).otherwise(c)
    out = rows.select("doc", "page", "tbl", "row", "__c", *[clean(at(r)).alias(n) for r, n in (("produto", "product"), ("servico", "service"), ("eixo", "axis"), ("data_pactuada", "due"), ("data_entrega", "delivered"), ("pactuado", "agreed"), ("justificativa", "reason"), ("status", "status"))])
    out = out.where((F.col("product") != "") & ~is_literal(F.col("product"), DELIVERY_LITERALS))
    dated = {c: F.when(F.col(c) != "", parse_date(F.col(c))) for c in ("due", "delivered")}
    return out.withColumns(dated).withColumn("state", delivery_status(F.when(F.col("status") != "", F.col("status")), F.array_compact("__c"))).drop("__c")


def better_of(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The rows of whichever of two extractions has more rows for a key, ties to ``a``; a column ``method`` says a or b."""
    both = a.withColumn("method", F.lit("a")).unionByName(b.withColumn("method", F.lit("b")))
    n = both.groupBy(key).agg(F.count_if(F.col("method") == "a").alias("na"), F.count_if(F.col("method") == "b").alias("nb"))
    best = n.select(F.col(key).alias("__k"), F.when(F.col("na") >= F.col("nb"), "a").otherwise("b").alias("__m"))
    return both.join(best, (F.col(key) == F.col("__k")) & (F.col("method") == F.col("__m")), "left_semi")


