import copy

import pytest

from stopline.operators import contract as ct
from stopline.operators import predictions as pr
from stopline.sources import pages as pg
from tests import feed
from tests.conftest import at

POLLED = at("2026-08-13 02:30:00")


def broken(spark, body, contract=ct.CONTRACT):
    pages = spark.createDataFrame([(POLLED, 0, 1, feed.text(body))], pg.PAGE_SCHEMA)
    found = ct.violations(pr.read_resources(pages, contract))
    rows = found.withColumn("m", ct.message(contract)).orderBy("section", "idx", "seq").collect()
    return [(r["clause"], r["path"]) for r in rows], [r["m"] for r in rows]


def mutated(change):
    data, included = feed.eight()
    body = feed.page(copy.deepcopy(data), copy.deepcopy(included))
    change(body)
    return body


def first(body):
    return body["data"][0]


CASES = [
    (lambda b: first(b)["attributes"].pop("direction_id"), "attr_missing", "attributes.direction_id", "missing"),
    (lambda b: first(b)["attributes"].update(direction_id="0"), "attr_type", "attributes.direction_id", "contract type 'int'"),
    (lambda b: first(b)["attributes"].update(direction_id=True), "attr_type", "attributes.direction_id", "value true"),
    (lambda b: first(b)["attributes"].update(direction_id=1.0), "attr_type", "attributes.direction_id", "contract type"),
    (lambda b: first(b)["attributes"].update(direction_id=2), "attr_allowed", "attributes.direction_id", "not in allowed values [0, 1]"),
    (lambda b: first(b)["attributes"].update(direction_id=None), "attr_null", "attributes.direction_id", "non-nullable"),
    (lambda b: first(b)["attributes"].update(arrival_time="soon"), "attr_type", "attributes.arrival_time", "string_datetime"),
    (lambda b: first(b)["attributes"].update(status=3), "attr_type", "attributes.status", "value 3"),
    (lambda b: first(b)["relationships"].pop("route"), "rel_missing", "relationships.route", "missing"),
    (lambda b: first(b)["relationships"].update(route=None), "rel_missing", "relationships.route", "missing"),
    (lambda b: first(b)["relationships"]["route"]["data"].update(id=23), "rel_id_type", "relationships.route.data.id", "(23)"),
    (lambda b: first(b)["relationships"]["stop"].update(data=["s1"]), "rel_id_type", "relationships.stop.data.id", "not a string"),
    (lambda b: first(b).update(type="prediction-v2"), "resource_type", "type", "data[0].type: 'prediction-v2'"),
    (lambda b: first(b).pop("type"), "resource_type", "type", "data[0].type: null"),
    (lambda b: first(b).pop("id"), "top_level", "id", "missing required top-level field 'id'"),
    (lambda b: b["included"][0].pop("attributes"), "top_level", "attributes", "included[0](schedule): missing"),
    (lambda b: b["included"][0]["attributes"].update(service_date="2026-08-12x"), "attr_type", "attributes.service_date", "string_date"),
]


@pytest.mark.parametrize("change,clause,path,words", CASES)
def test_one_broken_rule(spark, change, clause, path, words):
    rules, messages = broken(spark, mutated(change))
    assert rules == [(clause, path)]
    assert words in messages[0] and messages[0].startswith("page 1: ")


@pytest.mark.parametrize(
    "change",
    [
        lambda b: None,
        lambda b: first(b)["attributes"].update(arrival_time=None),
        lambda b: first(b)["attributes"].pop("arrival_time"),
        lambda b: first(b)["attributes"].update(arrival_time="2026-08-12T21:17:46.123Z"),
        lambda b: first(b)["relationships"].update(vehicle={"data": None}),
        lambda b: first(b)["relationships"].pop("schedule"),
        lambda b: b["included"][0]["attributes"].update(arrival_time=None),
        lambda b: b["included"].append({"id": "r", "type": "route"}),
        lambda b: (b.pop("included"), b.update(data=[])),
        lambda b: b.update(data=None),
    ],
)
def test_clean_pages(spark, change):
    assert broken(spark, mutated(change)) == ([], [])


def test_missing_attributes_break_two_rules(spark):
    rules, _ = broken(spark, mutated(lambda b: first(b).pop("attributes")))
    assert rules == [("top_level", "attributes"), ("attr_missing", "attributes.direction_id")]


def test_null_data_only_where_the_contract_forbids_it(spark):
    strict = copy.deepcopy(ct.CONTRACT)
    strict["prediction"]["relationships"]["route"]["nullable_data"] = False
    body = mutated(lambda b: first(b)["relationships"].update(route={"data": None}))
    assert broken(spark, body)[0] == []
    assert broken(spark, body, strict)[0] == [("rel_null_data", "relationships.route.data")]


def test_all_violations_in_order(spark):
    def change(b):
        b["data"][0]["attributes"]["direction_id"] = None
        b["data"][1]["attributes"]["direction_id"] = 5

    _, messages = broken(spark, mutated(change))
    assert ["data[0]" in messages[0], "data[1]" in messages[1], len(messages)] == [True, True, 2]
