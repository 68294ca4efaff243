"""The declared shape of a prediction page, checked for every page on the cluster.

The rules are data; each becomes a column expression over the page's variant resources. One row
per violation comes out, in page order; a clean page gives none.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopline.sources import pages as pg

# The contract for prediction pages, version 1.
CONTRACT = {
    "prediction": {
        "section": "data",
        "top_level": ["id", "type", "attributes", "relationships"],
        "attributes": {
            "direction_id": {"type": "int", "required": True, "nullable": False, "allowed": [0, 1]},
            "arrival_time": {"type": "string_datetime", "required": False, "nullable": True},
            "departure_time": {"type": "string_datetime", "required": False, "nullable": True},
            "status": {"type": "string", "required": False, "nullable": True},
        },
        "relationships": {
            "route": {"required": True, "nullable_data": True},
            "stop": {"required": True, "nullable_data": True},
            "trip": {"required": True, "nullable_data": True},
            "vehicle": {"required": False, "nullable_data": True},
            "schedule": {"required": False, "nullable_data": True},
        },
    },
    "schedule": {
        "section": "included",
        "top_level": ["id", "type", "attributes"],
        "attributes": {
            "arrival_time": {"type": "string_datetime", "required": False, "nullable": True},
            "service_date": {"type": "string_date", "required": False, "nullable": True},
        },
        "relationships": {},
    },
}
DATETIME_PREFIX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
DATE_WHOLE = r"^\d{4}-\d{2}-\d{2}$"

CLAUSES = [
    "resource_type",
    "top_level",
    "attr_missing",
    "attr_null",
    "attr_type",
    "attr_allowed",
    "rel_missing",
    "rel_null_data",
    "rel_id_type",
]

_VIOLATION = "struct<path:string,clause:string,value:string>"


def _at(path: str) -> Column:
    return F.try_variant_get("item", path, "variant")


def _shown(value: Column) -> Column:
    """A value as it stood in the JSON; text in single quotes."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(_kind(value) == "STRING", F.concat(F.lit("'"), text, F.lit("'"))).otherwise(F.to_json(value))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _violation(broken: Column, path: str, clause: str, value: Column | None = None) -> Column:
    shown = F.lit(None).cast("string") if value is None else value
    return F.when(
        broken, F.struct(F.lit(path).alias("path"), F.lit(clause).alias("clause"), shown.alias("value"))
    ).otherwise(F.lit(None).cast(_VIOLATION))


def _missing(value: Column) -> Column:
    return value.isNull()


def _null(value: Column) -> Column:
    """Present as a JSON null."""
    return value.isNotNull() & F.coalesce(F.is_variant_null(value), F.lit(False))


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def _has_type(value: Column, expected: str) -> Column:
    kind = _kind(value)
    text = F.try_variant_get(value, "$", "string")
    if expected == "int":
        # A whole number written without a fraction; JSON booleans have their own kind.
        return kind == "BIGINT"
    if expected == "string":
        return kind == "STRING"
    pattern = DATETIME_PREFIX if expected == "string_datetime" else DATE_WHOLE
    return (kind == "STRING") & text.rlike(pattern)


def _attribute_checks(name: str, rule: dict) -> list[Column]:
    path = f"attributes.{name}"
    value = _at(f"$.{path}")
    typed = F.coalesce(_has_type(value, rule["type"]), F.lit(False))
    checks = []
    if rule["required"]:
        checks.append(_violation(_missing(value), path, "attr_missing"))
    if not rule["nullable"]:
        checks.append(_violation(_null(value), path, "attr_null"))
    checks.append(_violation(_present(value) & ~typed, path, "attr_type", _shown(value)))
    if "allowed" in rule:
        inside = F.try_variant_get(value, "$", "bigint").isin(rule["allowed"])
        checks.append(
            _violation(_present(value) & typed & ~F.coalesce(inside, F.lit(False)), path, "attr_allowed", _shown(value))
        )
    return checks


def _relationship_checks(name: str, rule: dict) -> list[Column]:
    path = f"relationships.{name}"
    rel, data, rid = _at(f"$.{path}"), _at(f"$.{path}.data"), _at(f"$.{path}.data.id")
    checks = []
    if rule["required"]:
        checks.append(_violation(~_present(rel), path, "rel_missing"))
    if not rule["nullable_data"]:
        checks.append(_violation(_present(rel) & ~_present(data), f"{path}.data", "rel_null_data"))
    text_id = F.coalesce(_kind(rid) == "STRING", F.lit(False))
    checks.append(
        _violation(
            _present(rel) & _present(data) & ~text_id,
            f"{path}.data.id",
            "rel_id_type",
            F.coalesce(_shown(rid), F.lit("null")),
        )
    )
    return checks


def _resource_checks(spec: dict) -> Column:
    checks = [_violation(_missing(_at(f"$.{f}")), f, "top_level") for f in spec["top_level"]]
    for name, rule in spec["attributes"].items():
        checks += _attribute_checks(name, rule)
    for name, rule in spec["relationships"].items():
        checks += _relationship_checks(name, rule)
    return F.array_compact(F.array(*checks))


def check(resources: DataFrame, contract: dict = CONTRACT) -> DataFrame:
    """Resource rows with ``kind`` and ``found``, the rules each resource breaks.

    A wrong type in ``data`` is one violation and hides the resource's other rules. In ``included``
    only schedules are checked."""
    typed = resources.withColumn("kind", F.try_variant_get("item", "$.type", "string"))
    in_data = F.col("section") == "data"
    is_kind = lambda k: F.coalesce(F.col("kind") == k, F.lit(False))
    raw_type = F.coalesce(_shown(_at("$.type")), F.lit("null"))
    wrong = F.array(_violation(F.lit(True), "type", "resource_type", raw_type))
    found = (
        F.when(in_data & is_kind("prediction"), _resource_checks(contract["prediction"]))
        .when(in_data, wrong)
        .when((F.col("section") == "included") & is_kind("schedule"), _resource_checks(contract["schedule"]))
    )
    return typed.withColumn("found", F.coalesce(found, F.array().cast(f"array<{_VIOLATION}>")))


def violations(checked: DataFrame) -> DataFrame:
    """(page key, section, idx, seq, path, clause, value), one row per broken rule."""
    return checked.select(
        *pg.PAGE_KEY, "section", F.col("pos").alias("idx"), F.posexplode("found").alias("seq", "v")
    ).select(*pg.PAGE_KEY, "section", "idx", "seq", "v.path", "v.clause", "v.value")


OTHER_CLAUSE = "rel_id_type"
# The ledger's sentences, one per kind of violation; readers of the ledger match on them.
SENTENCES = {
    "resource_type": "{place}: {value}, expected 'prediction'",
    "top_level": "{where}: missing required top-level field '{path}'",
    "attr_missing": "{place}: missing (required by contract)",
    "rel_missing": "{place}: missing (required by contract)",
    "attr_null": "{place}: null, but contract marks this field non-nullable",
    "attr_type": "{place}: value {value} does not match contract type '{declared}'",
    "attr_allowed": "{place}: value {value} not in allowed values {allowed}",
    "rel_null_data": "{place}: null, but contract marks this relationship non-nullable",
    "rel_id_type": "{place}: not a string ({value})",
}


def message(contract: dict = CONTRACT) -> Column:
    """A violation as ledger text, naming page, resource and rule."""
    kind = F.when(F.col("section") == "data", F.lit("prediction")).otherwise(F.lit("schedule"))
    where = F.concat(
        F.format_string("%s[%d]", F.col("section"), F.col("idx")),
        F.when(kind == "schedule", "(schedule)").otherwise(""),
    )
    place = F.concat(where, F.lit("."), F.col("path"))
    declared = F.create_map(
        *[
            F.lit(x)
            for name, spec in contract.items()
            for attribute, rule in spec["attributes"].items()
            for x in (f"{name}.attributes.{attribute}", rule["type"])
        ]
    )
    allowed = F.create_map(
        *[
            F.lit(x)
            for name, spec in contract.items()
            for attribute, rule in spec["attributes"].items()
            if "allowed" in rule
            for x in (f"{name}.attributes.{attribute}", str(rule["allowed"]))
        ]
    )
    field = F.concat(kind, F.lit("."), F.col("path"))
    parts = {
        "where": where, "place": place, "path": F.col("path"), "value": F.col("value"),
        "declared": F.try_element_at(declared, field), "allowed": F.try_element_at(allowed, field),
    }
    text = filled(SENTENCES[OTHER_CLAUSE], parts)
    for clause, sentence in SENTENCES.items():
        if clause != OTHER_CLAUSE:
            text = F.when(F.col("clause") == clause, filled(sentence, parts)).otherwise(text)
    return F.concat(F.format_string("page %d: ", F.col("page_no")), text)


def filled(sentence: str, parts: dict[str, Column]) -> Column:
    """The sentence with each {name} replaced by a column; null where one of them is null."""
    pieces = [F.lit(p) if k % 2 == 0 else parts[p] for k, p in enumerate(re.split(r"\{(\w+)\}", sentence)) if p]
    return F.concat(*pieces)


def on_valid_pages(checked: DataFrame) -> DataFrame:
    """Resources of pages without any violation; a page with one is dropped whole, others stay."""
    bad = checked.filter(F.size("found") > 0).select(*pg.PAGE_KEY).distinct()
    return checked.join(bad, pg.PAGE_KEY, "left_anti")
