"""Operators on small tables: edge cases and invariants."""

import pytest
from pyspark.sql import functions as F

from corvina.functions.vocabularies import AXIS, IMPACT_SCALE, PROBABILITY, PROBABILITY_SCALE, TREATMENTS, Vocabulary
from corvina.operators import analytics, canonical, groups, harmonize, quality, review, schema
from corvina.sources import files, publish
from corvina.streaming import refresh


def matches(spark, vocab, *values):
    rows = spark.createDataFrame([(v,) for v in values], "raw string")
    return {r["raw"]: (r["match"], round(r["score"], 3), r["method"]) for r in canonical.match_values(rows, "raw", vocab).collect()}


def test_aliases_and_terms(spark):
    got = matches(spark, PROBABILITY_SCALE, "Pouca", "1", "5", "baixa", "raro", "", None)
    assert got["Pouca"] == ("pouco provável", 0.95, "alias") and got["1"][0] == "raro" and got["5"][0] == "praticamente certo"
    assert got["raro"] == ("raro", 1.0, "exact") and got[""] == ("", 0.0, "unmatched") and got[None] == ("", 0.0, "unmatched")


def test_similarity(spark):
    got = matches(spark, AXIS, "Governaca e Gestao de Dadoss", "zzz")
    assert got["Governaca e Gestao de Dadoss"][0] == "Governança e Gestão de Dados" and got["Governaca e Gestao de Dadoss"][2] == "fuzzy_high"
    assert got["zzz"][2] == "unmatched"


def test_earlier_alias_wins(spark):
    v = Vocabulary("p", ("Login Único",), {"Login Unico": "A", "Login Único": "B"}, literal=1.0, folded=0.98)
    assert matches(spark, v, "Login Único")["Login Único"][:2] == ("A", 0.98)


def test_canonicalize_keeps_rows(spark):
    rows = spark.createDataFrame([(1, "alta"), (2, None), (3, "qqqq"), (4, "alta")], "id int, raw string")
    got = {r["id"]: r for r in canonical.canonicalize(rows, "raw", IMPACT_SCALE).collect()}
    assert len(got) == 4 and got[1]["impact_value"] == got[4]["impact_value"] == "alto" and got[3]["impact_value"] == "qqqq" and got[3]["impact_doubt"] and got[2]["impact_score"] == 0.0


def test_composite(spark):
    rows = spark.createDataFrame([("mitigar; transferir",), (None,), ("Mitigar",)], "raw string")
    got = {r["raw"]: (r["treatment_value"], r["treatment_parts"]) for r in canonical.composite(rows, "raw", "raw", TREATMENTS).collect()}
    assert got["mitigar; transferir"] == ("mitigar; transferir", 2) and got["Mitigar"] == ("mitigar", 1) and got[None] == ("", 0)


def test_harmonize(spark):
    cells = ["transferir; transferir", "mitigar; transferir", "de de Ocor-", "nan", "mitigar", None]
    rows = spark.createDataFrame([(i, "o", c) for i, c in enumerate(cells)], "ord int, owner string, t string")
    out, log = harmonize.harmonize(rows, {"t": TREATMENTS.terms}, order="ord", owner="owner")
    assert [r["t"] for r in out.orderBy("ord").collect()] == ["transferir", "", "", "", "mitigar", ""]
    assert {(r["row"], r["reason"]) for r in log.collect()} == {(0, "deduplicated"), (1, "multiple_values"), (2, "column_bleed")}
    assert [r["needs_review"] for r in out.orderBy("ord").collect()] == [False, True, True, False, False, False]
    again, log2 = harmonize.harmonize(out.select("ord", "owner", "t"), {"t": TREATMENTS.terms}, order="ord", owner="owner")
    assert log2.isEmpty() and again.count() == 6


def test_corrections(spark):
    rows = spark.createDataFrame([(1, "A", "x", ""), (2, "A", "x", None), (3, "B", "y", "q")], "ord int, org string, f string, g string")
    fixes = spark.createDataFrame([(1, "A", "f", "x", "X"), (2, "A", "g", None, "filled"), (3, "B", "f", "no", "N"), (4, "B", "h", "y", "N")], "ord int, org string, field string, original string, corrected string")
    out, done = review.apply_corrections(rows, fixes, key="org", order="ord", fields=("f", "g"))
    got = {r["ord"]: (r["f"], r["g"], r["corrected_fields"]) for r in out.collect()}
    assert got == {1: ("X", "filled", "f,g"), 2: ("x", None, ""), 3: ("y", "q", "")}
    assert {r["ord"]: r["applied"] for r in done.collect()} == {1: True, 2: True, 3: False, 4: False}


def test_owner_and_groups(spark):
    rows = spark.createDataFrame([("B", "t"), ("A", "t"), ("C", None)], "k string, c string")
    got = {r["k"]: r["is_owner"] for r in groups.own_by_content(rows, F.col("c"), "k").collect()}
    assert got == {"A": True, "B": False, "C": False}
    members = spark.createDataFrame([("H", "A"), ("H", "Z"), ("H", "H")], "head string, member string")
    months = spark.createDataFrame([("A", "2024-05"), ("Q", "2024-01")], "k string, m string")
    assert {tuple(r) for r in groups.group_minimum(months, members, "k", "m").collect()} == {("A", "2024-05"), ("Z", "2024-05"), ("H", "2024-05"), ("Q", "2024-01")}


def test_gate(spark):
    report = quality.checks(spark.range(5), {"n": ("max", 4), "m": ("min", 1)}, n=F.count("*"), m=F.max("id"))
    with pytest.raises(quality.GateError, match="^n$"):
        quality.gate(report)
    assert quality.same_rows(spark.range(3), spark.range(3)) and not quality.same_rows(spark.range(3), spark.range(4))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k string, v string")
    assert analytics.concentration(none, "k", 0.2).count() == 1
    assert analytics.jaccard(none, "k", "v").isEmpty() and analytics.top_k(none, "k", 3).isEmpty()
    assert analytics.missing_rates(none, ["k"]).count() == 1
    assert canonical.match_values(none, "k", IMPACT_SCALE).isEmpty()


def test_fingerprint_ignores_order(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string"), spark.createDataFrame([(2, None), (1, "x")], "a int, b string")
    assert quality.fingerprint(a, "a", "b").first() == quality.fingerprint(b, "a", "b").first()


def test_schema_and_descriptors():
    t = schema.Table("risks", (schema.Field("org", required=True), schema.score("s", "Score"), schema.method("m", "Method")), key=("org",), references={"org": ("orgs", "id")})
    assert schema.json_property(t.fields[0]) == {"type": "string"} and schema.json_property(t.fields[1])["type"] == ["number", "null"]
    p = schema.datapackage("x", "X", [t], {"risks": {"path": "r.csv"}}, keywords=["k"])
    assert p["resources"][0]["schema"]["foreignKeys"][0]["reference"] == {"resource": "orgs", "fields": ["id"]}
    assert schema.schema_org(p, url="http://u")["distribution"][0]["contentUrl"] == "http://u/r.csv"
    assert schema.skos("s", "S", PROBABILITY, {"raro": ["rara", "raro"]}, ordinal=True)["skos:hasTopConcept"][0] == {"@id": "s/raro", "@type": "skos:Concept", "skos:prefLabel": "raro", "skos:inScheme": "s", "skos:altLabel": ["rara"], "skos:notation": 1}
    assert t.strict({"org": ("a",)}).fields[0].enum == ("a",) and schema.spark_schema(t)["s"].metadata["maximum"] == 1.0
    assert schema.citation("title: T\nauthors:\n  - name: A\n    orcid: 1\n")["authors"] == [{"name": "A", "orcid": "1"}]


def test_table_violations(spark):
    t = schema.Table("r", (schema.Field("org", required=True), schema.score("s", ""), schema.Field("e", enum=("a",))))
    rows = spark.createDataFrame([("x", 0.5, "a"), (None, 2.0, "b")], "org string, s double, e string")
    assert {tuple(r) for r in schema.check_table(rows, t).collect()} == {("org", "required", 1), ("s", "range", 1), ("e", "enum", 1)}


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'say "hi"'), ("b", "two\nlines"), ("c", None)], "k string, v string")
    files.write_csv(rows, str(tmp_path / "x"), "k")
    back = files.read_csv(spark, str(tmp_path / "x")).orderBy("k").collect()
    assert [r["v"] for r in back] == ['say "hi"', "two\nlines", None]
    assert "".join(files.csv_lines(rows, "k", bom=True)).startswith("﻿k,v\na,")


def test_files_and_stages(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF" + b"0" * 2000)
    (tmp_path / "b.pdf").write_bytes(b"html")
    assert {r["name"]: r["valid"] for r in files.file_rows(spark, str(tmp_path), magic=b"%PDF", least=1000).collect()} == {"a.pdf": True, "b.pdf": False}
    made = []
    make = lambda: (made.append(1), spark.range(3))[1]
    for key in (files.state_key("x"), files.state_key("x"), files.state_key("y")):
        assert files.staged(spark, str(tmp_path / "s"), "t", key, make).count() == 3
    assert len(made) == 2
    out = files.nested_json(spark.createDataFrame([("k", 2, "b"), ("k", 1, "a")], "k string, o int, v string"), "k", ["o"], ["v"], F.lit("now")).first()
    assert out["json"] == '{"metadata":{"exported_at":"now","total":2},"data":{"k":[{"v":"a"},{"v":"b"}]}}'


def test_publish(spark, tmp_path):
    rows = publish.rows_of(spark.range(2))
    assert publish.markdown_table(rows, ["id"]) == "| id |\n|---|\n| 0 |\n| 1 |\n"
    assert publish.script_constants({"A": [1]}) == "const A = [1];\n"
    page = publish.between_marks("<head></head>", "x", "1")
    assert publish.between_marks(page, "x", "1") == page and publish.between_marks(page, "x", "2").count("x:start") == 1
    assert publish.bundle({"b": b"2", "a": b"1"}) == publish.bundle({"a": b"1", "b": b"2"})
    with pytest.raises(FileNotFoundError):
        publish.bundle({}, required=["a"])
    (tmp_path / "f").write_text("1")
    assert publish.stale({"f": "1", "g": "2"}, tmp_path) == ["g"] and publish.file_facts(tmp_path / "f")["bytes"] == 1
    with pytest.raises(ValueError, match="more than 1"):
        publish.rows_of(spark.range(2), most=1)


def test_streaming_refresh(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.createDataFrame([("a",), ("a",), ("b",)], "t string").write.parquet(source)
    for _ in range(2):
        refresh.refresh(refresh.once_by_content(refresh.new_rows(spark, source, "t string"), "t"), target, mark)
        assert sorted(r["t"] for r in spark.read.parquet(target).collect()) == ["a", "b"]
    spark.createDataFrame([("b",), ("c",)], "t string").write.mode("append").parquet(source)
    refresh.refresh(refresh.once_by_content(refresh.new_rows(spark, source, "t string"), "t"), target, mark)
    assert sorted(r["t"] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]
    assert refresh.unprocessed(spark.range(3), spark.range(2), "id").count() == 1


def test_standardized_deliveries_append_to_what_rows_have(spark):
    from corvina.operators.standardize import split_fragments, standardize_deliveries

    rows = [(1, "Evolução do Serviço", "Projetos Especiais", False, None, "high", "x"), (2, "Algo totalmente fora do vocabulário", "Projetos Especiais", True, "antes", "high", "x"),
            (3, "Evolução do Serviço", "Projetos Especiais", True, "antes", "medium", "x"), (4, "Evolução do Serviço", "Projetos Especiais", True, None, "medium", "x"), (5, "Outros", "", False, None, "high", " rência ")]
    df = spark.createDataFrame(rows, "ord int, product string, axis string, needs_review boolean, review_reason string, confidence string, service string")
    out = standardize_deliveries(df)
    got = {r["ord"]: r for r in out.collect()}
    assert got[1]["axis_value"] == "Serviços Digitais e Melhoria da Qualidade" and got[1]["needs_review"] and got[1]["review_reason"].startswith("eixo corrigido por cross-validation: 'Projetos")
    assert got[2]["product_value"] == "UNMATCHED" and got[2]["confidence"] == "low" and got[2]["review_reason"].startswith("produto não reconhecido")
    assert got[3]["review_reason"].startswith("antes; eixo corrigido: 'Projetos") and got[3]["confidence"] == "medium"
    assert got[4]["review_reason"] is None and got[4]["needs_review"]
    kept, dropped = split_fragments(out)
    assert [r["ord"] for r in dropped.collect()] == [5] and kept.count() == 4
    assert standardize_deliveries(df.limit(0)).count() == 0


def test_standardized_risks_append_and_grade(spark):
    from corvina.operators.standardize import match_stats, risk_mappings, standardize_risks

    rows = [(1, "raro", "alto", "mitigar", False, None, "high"), (2, "xpto sem sentido", "alto", "Mitigar/Tra nsferir", False, "antes", "high"), (3, "raro", "alto", "aceitar", True, "antes", "medium"), (4, None, "alto", "transferir; transferir", False, None, "high")]
    df = spark.createDataFrame(rows, "ord int, probability string, impact string, treatment string, needs_review boolean, review_reason string, confidence string")
    got = {r["ord"]: r for r in standardize_risks(df).collect()}
    assert not got[1]["needs_review"] and got[1]["confidence"] == "high" and got[1]["review_reason"] is None
    assert got[2]["treatment_value"] == "mitigar; transferir" and got[2]["confidence"] == "low" and got[2]["probability_value"] == "xpto sem sentido"
    assert got[2]["review_reason"].startswith("antes; probabilidade não reconhecida (score: ") and got[2]["review_reason"].endswith("tratamento múltiplo/composto ('mitigar; transferir')")
    assert got[3]["confidence"] == "medium" and got[3]["review_reason"] == "antes"
    assert got[4]["probability_method"] == "unmatched" and got[4]["probability_score"] == 0 and got[4]["needs_review"]
    stats = {r["type"]: (r["exact"], r["fuzzy"], r["unmatched"]) for r in match_stats(risk_mappings(df)).collect()}
    assert stats["impact"] == (4, 0, 0) and stats["probability"] == (2, 0, 2)


def test_audit_counts_and_report(spark):
    from corvina.operators.reports import render
    from corvina.operators.tables import flag_audited
    from test_tables import _AUDIT, _AUDITED

    rows = spark.createDataFrame(_AUDIT, "ord int, probability string, impact string, treatment string")
    out, counts = flag_audited(rows.selectExpr("*", "false AS needs_review", "'antes' AS review_reason", "'high' AS confidence"), _AUDITED, "ord")
    assert {r["category"]: r["n"] for r in counts.collect()} == {"header_captured": 1, "fragment": 1, "column_shift": 3, "column_bleed": 1}
    reasons = {r["ord"]: r["review_reason"] for r in out.collect()}
    assert reasons[1] == "antes; probabilidade: header capturado ('Probabilidade')" and reasons[4] == "antes"
    assert render("Nota", [("Entregas", {"total": 4574, "média": 1234.56, "nada": None})]) == "# Nota\n\n## Entregas\n\n- total: 4.574\n- média: 1.234,6\n- nada: —\n"
