"""Results whose order is their feature, read as they come."""

from corvina.operators import reports, standardize

D = "ord int, product string, axis string, owner string, service string, table_kind string"
R = "ord int, probability string, impact string, treatment string, owner string, risk string"


def tables(spark):
    d = spark.createDataFrame([(i, p, a, f"o{i % 3}", "s", "k") for i, (p, a) in enumerate([("zzz qqq", "Canais"), ("Outros", "xx"), ("Adequacao LGPD x", "Canais"), ("zzz qqq", "yy"), ("Evolucao do Servico Dig", None)])], D).repartition(4)
    r = spark.createDataFrame([(i, p, t, "mitigar", f"o{i % 2}", "risk") for i, (p, t) in enumerate([("provavl", "alto"), ("xpto", "muito alt"), ("raro", "nada aqui"), ("xpto", "alto")])], R).repartition(4)
    return standardize.standardize_deliveries(d), standardize.standardize_risks(r)


def test_mappings_by_type_and_text(spark):
    d = spark.createDataFrame([(i, p, a) for i, (p, a) in enumerate([("b", "z"), ("a", "y"), ("c", None)])], "ord int, product string, axis string").repartition(3)
    got = [(x["type"], x["original"]) for x in standardize.delivery_mappings(d).collect()]
    assert got == sorted(got) and len(got) == 6


def test_queue_by_priority_owner_and_kind(spark):
    got = [(x["priority"], x["owner"], x["kind"]) for x in reports.ranked_queue(*tables(spark)).collect()]
    assert got == sorted(got) and len({p for p, _, _ in got}) > 1


def test_buckets_by_impact(spark):
    d, r = tables(spark)
    rows = reports.field_rows(d, ("product", "axis"), context="service").unionByName(reports.field_rows(r, ("probability", "impact", "treatment"), context="risk"))
    got = [(-x["impact"], -x["n"], x["field"], x["original"]) for x in reports.field_buckets(rows, ("fuzzy_low", "unmatched")).collect()]
    assert got == sorted(got) and len(got) >= 4 and got[0][3] in ("zzz qqq", "xpto")


def test_least_frequent_first(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbbccdde"], "c string").repartition(3)
    assert [(x["c"], x["n"]) for x in reports.ascending_top(df, "c", 3).collect()] == [("c", 2), ("b", 3), ("a", 3)]
