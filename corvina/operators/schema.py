"""A declared model of tables and the descriptors made from it.

A table is a list of fields with title, description, type and constraints. The same model
gives Spark schemas, violation checks and the descriptors that open-data catalogues read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

_SPARK = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class Field:
    """One column: what it means and which values it may have."""

    name: str
    type: str = "string"
    title: str = ""
    description: str = ""
    required: bool = False
    enum: tuple[str, ...] = ()
    minimum: float | None = None
    maximum: float | None = None
    format: str | None = None


@dataclass(frozen=True)
class Table:
    """A table's fields, its key, and its references to other tables' keys."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    title: str = ""
    description: str = ""

    def strict(self, enums: Mapping[str, Sequence[str]]) -> Table:
        """The same table with closed enumerations for some fields."""
        from dataclasses import replace

        return replace(self, fields=tuple(replace(f, enum=tuple(enums[f.name])) if f.name in enums else f for f in self.fields))


def score(name: str, title: str) -> Field:
    """A similarity between 0 and 1."""
    return Field(name, "number", title, minimum=0.0, maximum=1.0)


def method(name: str, title: str) -> Field:
    """How a value was matched."""
    return Field(name, "string", title, enum=("exact", "alias", "fuzzy_high", "fuzzy_low", "unmatched"))


def spark_schema(table: Table) -> T.StructType:
    """The Spark schema, each field's description and constraints in its metadata."""
    return T.StructType([T.StructField(f.name, _SPARK[f.type], not f.required, {k: v for k, v in (("title", f.title), ("description", f.description), ("enum", list(f.enum)), ("minimum", f.minimum), ("maximum", f.maximum)) if v not in ("", [], None)}) for f in table.fields])


def check_table(df, table: Table):
    """Violations of the table's required fields, enumerations and ranges, from one scan."""
    from corvina.operators.quality import violations

    ranged = {f.name: (f.minimum, f.maximum) for f in table.fields if f.minimum is not None and f.maximum is not None}
    return violations(df, required=[f.name for f in table.fields if f.required], enums={f.name: f.enum for f in table.fields if f.enum}, ranges=ranged)


def frictionless_field(f: Field) -> dict[str, Any]:
    """A Table Schema field."""
    rules = {k: v for k, v in (("required", f.required or None), ("enum", list(f.enum) or None), ("minimum", f.minimum), ("maximum", f.maximum)) if v is not None}
    out = {"name": f.name, "type": f.type, "title": f.title, "description": f.description, "format": f.format, "constraints": rules}
    return {k: v for k, v in out.items() if v}


def json_property(f: Field) -> dict[str, Any]:
    """A JSON Schema property; null is allowed unless the field is required."""
    out: dict[str, Any] = {"type": f.type if f.required else [f.type, "null"]}
    if f.description or f.title:
        out["description"] = f.description or f.title
    if f.enum:
        out["enum"] = [*f.enum, *([] if f.required else [None])]
    return out | {k: v for k, v in (("minimum", f.minimum), ("maximum", f.maximum), ("format", f.format)) if v is not None}


def nested_schema(table: Table, title: str) -> dict[str, Any]:
    """JSON Schema of the export keyed by owner: metadata, and a list of entries for each key."""
    entry = {"type": "object", "properties": {f.name: json_property(f) for f in table.fields}, "required": [f.name for f in table.fields if f.required]}
    meta = {"type": "object", "properties": {"exported_at": {"type": "string"}, "total": {"type": "integer", "minimum": 0}}, "required": ["exported_at", "total"]}
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": title, "type": "object", "required": ["metadata", "data"], "properties": {"metadata": meta, "data": {"type": "object", "additionalProperties": {"type": "array", "items": entry}}}}


def datapackage(name: str, title: str, tables: Sequence[Table], files: Mapping[str, Mapping[str, Any]], **more: Any) -> dict[str, Any]:
    """A data package descriptor; ``files`` gives path, bytes and hash of each table's file.

    ``more`` may hold license, version, keywords, themes and a date ``created``, which becomes a time at midnight UTC if it is a day.
    """
    if len(str(more.get("created", ""))) == 10:
        more["created"] = f"{more['created']}T00:00:00Z"
    resources = []
    for t in tables:
        schema: dict[str, Any] = {"fields": [frictionless_field(f) for f in t.fields], "missingValues": [""]}
        if t.key:
            schema["primaryKey"] = list(t.key)
        if t.references:
            schema["foreignKeys"] = [{"fields": [c], "reference": {"resource": other, "fields": [key]}} for c, (other, key) in t.references.items()]
        resources.append({"name": t.name, "title": t.title or t.name, "profile": "tabular-data-resource", "format": "csv", "encoding": "utf-8", **files.get(t.name, {}), "schema": schema})
    return {"profile": "tabular-data-package", "name": name, "title": title, "resources": resources, **more}


def _checksum(resource: Mapping[str, Any]) -> str | None:
    """The sha256 of a resource's file, where its descriptor has one."""
    kind, _, value = str(resource.get("hash", "")).rpartition(":")
    return value if value and kind in ("", "sha256") else None


def _download(resource: Mapping[str, Any], url: str) -> str:
    return f"{url}/{resource.get('path', resource['name'])}"


def _media(resource: Mapping[str, Any]) -> str:
    return {"csv": "text/csv", "json": "application/json"}.get(resource["format"], f"text/{resource['format']}")


def _full(value: dict[str, Any]) -> dict[str, Any]:
    return {k: v for k, v in value.items() if v not in (None, "", [], {})}


def schema_org(package: Mapping[str, Any], *, url: str, creators: Sequence[str | tuple[str, str]] = (), modified: str | None = None) -> dict[str, Any]:
    """A schema.org Dataset with a download, checksum included, for each resource.

    Of ``package`` it takes title, description, license, keywords, version, issued, language, publisher, status, source and themes
    (pairs of address and label); ``creators`` are names or pairs of name and affiliation.
    """
    people = [c if isinstance(c, tuple) else (c, "") for c in creators]
    out = {
        "@context": "https://schema.org/", "@type": "Dataset", "name": package["title"], "description": package.get("description"), "url": url, "license": package.get("license"), "dateModified": modified,
        "version": package.get("version"), "datePublished": package.get("issued"), "inLanguage": package.get("language"), "isAccessibleForFree": True, "keywords": list(package.get("keywords", ())),
        "creator": [_full({"@type": "Person", "name": n, "affiliation": {"@type": "Organization", "name": a} if a else None}) for n, a in people],
        "publisher": {"@type": "Organization", "name": package["publisher"]} if package.get("publisher") else None, "creativeWorkStatus": package.get("status"), "isBasedOn": package.get("source"),
        "about": [{"@type": "Thing", "@id": uri, "name": label} for uri, label in package.get("themes", ())],
        "distribution": [_full({"@type": "DataDownload", "name": r["title"], "encodingFormat": _media(r), "contentUrl": _download(r, url), "sha256": _checksum(r)}) for r in package["resources"]],
    }
    return _full(out)


def dcat(package: Mapping[str, Any], *, url: str) -> dict[str, Any]:
    """A DCAT dataset in JSON-LD; its distributions have licence and checksum. It takes the same keys of ``package`` as ``schema_org``."""
    at = lambda uri: {"@id": uri} if uri else None
    checksum = lambda r: {"@type": "spdx:Checksum", "spdx:algorithm": "spdx:checksumAlgorithm_sha256", "spdx:checksumValue": _checksum(r)} if _checksum(r) else None
    one = lambda r: {"@type": "dcat:Distribution", "dct:title": r["title"], "dcat:mediaType": _media(r), "dct:format": r["format"].upper(), "dcat:downloadURL": _download(r, url), "dct:license": at(package.get("license")), "spdx:checksum": checksum(r)}
    return _full({
        "@context": {"dcat": "http://www.w3.org/ns/dcat#", "dct": "http://purl.org/dc/terms/", "foaf": "http://xmlns.com/foaf/0.1/", "spdx": "http://spdx.org/rdf/terms#", "skos": "http://www.w3.org/2004/02/skos/core#"},
        "@type": "dcat:Dataset", "@id": url, "dct:title": package["title"], "dct:description": package.get("description", ""), "dct:issued": package.get("issued"), "dct:modified": package.get("modified"),
        "dcat:version": package.get("version"), "dct:language": package.get("language"), "dct:license": at(package.get("license")), "dct:source": at(package.get("source")),
        "dct:publisher": {"@type": "foaf:Organization", "foaf:name": package["publisher"]} if package.get("publisher") else None,
        "dcat:theme": [{"@id": uri, "skos:prefLabel": label} for uri, label in package.get("themes", ())], "dcat:keyword": list(package.get("keywords", ())), "dcat:distribution": [_full(one(r)) for r in package["resources"]],
    })


def prov(entity: str, activity: str, sources: Sequence[str], *, started: str, ended: str, agent: str, parts: Sequence[str] = ()) -> dict[str, Any]:
    """Provenance: an entity, and its ``parts`` such as files, made by an activity from sources on behalf of an agent."""
    made = [entity, *parts]
    return {
        "entity": {**{e: {"prov:type": "dataset"} for e in made}, **{s: {"prov:type": "source"} for s in sources}},
        "activity": {activity: {"prov:startTime": started, "prov:endTime": ended}},
        "agent": {agent: {}},
        "wasGeneratedBy": {f"_:g{i}": {"prov:entity": e, "prov:activity": activity} for i, e in enumerate(made)},
        "used": {f"_:u{i}": {"prov:activity": activity, "prov:entity": s} for i, s in enumerate(sources)},
        "wasAssociatedWith": {"_:a0": {"prov:activity": activity, "prov:agent": agent}},
    }


def ckan(package: Mapping[str, Any], *, url: str, owner: str, license_id: str | None = None) -> dict[str, Any]:
    """A CKAN package; resources have format, size and hash where the package knows them."""
    one = lambda r: _full({"name": r["name"], "title": r["title"], "url": _download(r, url), "format": r["format"].upper(), "mimetype": _media(r), "size": r.get("bytes"), "hash": _checksum(r)})
    return _full({"name": package["name"], "title": package["title"], "owner_org": owner, "notes": package.get("description", ""), "version": package.get("version"), "license_id": license_id, "tags": [{"name": k} for k in package.get("keywords", ())], "resources": [one(r) for r in package["resources"]]})


def skos(scheme: str, title: str, terms: Sequence[str], alternatives: Mapping[str, Sequence[str]] | None = None, *, ordinal: bool = False) -> dict[str, Any]:
    """A concept scheme; an ordinal one numbers its terms from 1."""
    concepts = []
    for i, t in enumerate(terms, 1):
        c: dict[str, Any] = {"@id": f"{scheme}/{t.lower().replace(' ', '-').replace('/', '-')}", "@type": "skos:Concept", "skos:prefLabel": t, "skos:inScheme": scheme}
        if alt := sorted(set((alternatives or {}).get(t, ())) - {t}):
            c["skos:altLabel"] = alt
        if ordinal:
            c["skos:notation"] = i
        concepts.append(c)
    return {"@context": {"skos": "http://www.w3.org/2004/02/skos/core#"}, "@id": scheme, "@type": "skos:ConceptScheme", "skos:prefLabel": title, "skos:hasTopConcept": concepts}


def citation(text: str) -> dict[str, Any]:
    """Title, version, date and authors of a citation file of plain keys; nested keys of authors are read, others kept as text."""
    out: dict[str, Any] = {"authors": []}
    inside = False
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        key, _, value = line.strip().lstrip("- ").partition(":")
        value = value.strip().strip("\"'")
        if not line[0].isspace() and not line.startswith("-"):
            inside = key == "authors"
            if not inside:
                out[key] = value
        elif inside:
            if line.strip().startswith("-"):
                out["authors"].append({})
            out["authors"][-1][key] = value
    return out


def dump(value: Any) -> str:
    """JSON text with a final line end, characters beyond ASCII as they are."""
    return json.dumps(value, ensure_ascii=False, indent=2) + "\n"
