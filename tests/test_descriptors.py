"""Descriptors of an export: checksums, licence, themes, dates, provenance."""

from corvina.operators import schema

LICENCE = "https://creativecommons.org/licenses/by/4.0/"
THEMES = (("http://vocab.example/administration", "Administração"), ("http://vocab.example/technology", "Tecnologia"))


def package():
    risks = schema.Table("risks", (schema.Field("owner", required=True), schema.score("score", "Score")), references={"owner": ("owners", "owner")}, title="Riscos")
    owners = schema.Table("owners", (schema.Field("owner", required=True),), key=("owner",))
    files = {"risks": {"path": "output/risks.csv", "bytes": 12, "hash": "sha256:" + "ab" * 32}}
    return schema.datapackage("corpus", "Corpus", (risks, owners), files, license=LICENCE, version="1.2", created="2026-05-12", issued="2026-05-12", language="pt-BR", keywords=["dados"], themes=THEMES, publisher="Instituto", status="Versão preliminar", source="https://portal.example")


def test_package():
    p = package()
    risks = p["resources"][0]
    assert p["created"] == "2026-05-12T00:00:00Z" and risks["hash"].startswith("sha256:")
    assert risks["schema"]["foreignKeys"][0]["reference"]["resource"] == "owners" and p["resources"][1]["schema"]["primaryKey"] == ["owner"]
    assert schema.datapackage("x", "X", (), {}, created="2026-05-12T10:00:00Z")["created"] == "2026-05-12T10:00:00Z"


def test_schema_org():
    got = schema.schema_org(package(), url="http://u", creators=["Ana", ("Rui", "Instituto")], modified="2026-06-01")
    assert {t["@id"] for t in got["about"]} == {uri for uri, _ in THEMES} and got["creativeWorkStatus"] == "Versão preliminar" and got["version"] == "1.2"
    assert got["distribution"][0]["sha256"] == "ab" * 32 and "sha256" not in got["distribution"][1] and got["distribution"][0]["contentUrl"] == "http://u/output/risks.csv"
    assert got["creator"] == [{"@type": "Person", "name": "Ana"}, {"@type": "Person", "name": "Rui", "affiliation": {"@type": "Organization", "name": "Instituto"}}]


def test_dcat():
    got = schema.dcat(package(), url="http://u")
    first, second = got["dcat:distribution"]
    assert first["spdx:checksum"]["spdx:checksumValue"] == "ab" * 32 and "spdx:checksum" not in second
    assert first["dct:license"] == {"@id": LICENCE} == got["dct:license"] and [t["skos:prefLabel"] for t in got["dcat:theme"]] == ["Administração", "Tecnologia"]


def test_prov():
    got = schema.prov("corpus", "run", ["portal"], started="a", ended="b", agent="pipeline", parts=["risks.csv", "owners.csv"])
    assert {g["prov:entity"] for g in got["wasGeneratedBy"].values()} == {"corpus", "risks.csv", "owners.csv"} and got["used"]["_:u0"]["prov:entity"] == "portal"


def test_ckan():
    got = schema.ckan(package(), url="http://u", owner="org", license_id="cc-by")
    assert got["license_id"] == "cc-by" and got["resources"][0]["hash"] == "ab" * 32 and got["resources"][0]["size"] == 12 and got["tags"] == [{"name": "dados"}]
