import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spanledger.functions.jsonpath import extract_paths
from spanledger.operators.flatten import (
    RECORD_ROUTES, RECORD_SCALARS, flatten_arrays_apart, flatten_json, route, route_all, tag_targets,
)

DOCS = [
    '{"name": "Al", "contacts": ["c0", "c1"], "skills": ["s0", "s1", "s2"], "hobbies": []}',
    '{"name": null, "address": {"city": "X", "zip": 1234}, "contacts": ["p", {"z": 1}, null, 2, 1.50]}',
    '{"product": {"name": "P", "details": {"brand": "B", "specs": {"ram": "8", "storage": null}}}}',
    '{"product": "just text", "address": "no object", "contacts": "no list"}',
    '{"address": {"city": {"deep": [1, 2]}}, "name": true, "skills": [["a"], []]}',
    '{"name": 12.50, "address": {"city": 1e3, "zip": [1.50]}}',
    "not json at all",
    "[1, 2]",
    "{}",
    None,
]


@pytest.fixture(scope="module")
def docs(spark):
    data = [(str(i), f"2024-01-{1 + i:02d} 10:00:00", d) for i, d in enumerate(DOCS)]
    return spark.createDataFrame(data, "record_id string, t string, json_field string").select(
        "record_id", F.col("t").cast("timestamp_ntz").alias("updated_at"), "json_field")


def test_one_parse_equals_path_by_path(docs):
    paths = {**RECORD_SCALARS, "city_deep": "$.address.city", "contacts_text": "$.contacts"}
    parsed = extract_paths(docs, "json_field", paths)
    for name, path in paths.items():
        expected = docs.select("record_id", F.get_json_object("json_field", path).alias("v"))
        assert rows(parsed, "record_id", name) == rows(expected), path


def test_single_from_json_in_the_plan(docs):
    plan = extract_paths(docs, "json_field", RECORD_SCALARS, {"a": "$.contacts"})._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("from_json(") == 1 and "get_json_object" not in text


def test_arrays(docs):
    out = extract_paths(docs, "json_field", {}, {"a": "$.contacts", "b": "$.skills"}).select("record_id", "a", "b")
    found = {r.record_id: (r.a, r.b) for r in out.collect()}
    assert found["0"] == (["c0", "c1"], ["s0", "s1", "s2"])
    assert found["1"][0] == ["p", '{"z":1}', None, "2", "1.5"]
    assert found["4"][1] == ['["a"]', "[]"]
    assert all(found[i] == (None, None) for i in "356789")


def test_parents_and_subscripts_fall_back(docs):
    paths = {"whole": "$.product", "part": "$.product.name", "first": "$.contacts[0]"}
    out = extract_paths(docs, "json_field", paths, {"contacts": "$.contacts"})
    found = {r.record_id: r for r in out.collect()}
    assert json.loads(found["2"].whole)["name"] == "P" and found["2"].part == "P"
    assert found["3"].whole == "just text" and found["3"].part is None
    assert found["0"].first == "c0" and found["0"].contacts == ["c0", "c1"]


def test_same_path_as_text_and_as_list(docs):
    out = extract_paths(docs, "json_field", {"text": "$.contacts"}, {"list": "$.contacts"})
    assert out.filter("record_id = '0'").select("text", "list").first() == ('["c0","c1"]', ["c0", "c1"])


def test_product_of_arrays(docs):
    out = flatten_json(docs, batch_id="b", processed_at="2024-02-01 00:00:00")
    counts = dict(out.groupBy("record_id").count().collect())
    assert counts == {"0": 6, "1": 5, "4": 2, **{i: 1 for i in "2356789"}}
    first = out.filter("record_id = '0'")
    assert rows(first, "contact_index", "skill_index") == [(c, s) for c in range(2) for s in range(3)]
    assert first.filter("hobby is null and hobby_index is null").count() == 6
    null_element = out.filter("record_id = '1' and contact_index = 2").first()
    assert null_element.contact is None
    assert dict(out.dtypes)["contact_index"] == "bigint"
    assert {str(r[0]) for r in out.filter("record_id = '2'").select("partition_date").collect()} == {"2024-01-03"}


def test_arrays_apart(docs):
    outputs = flatten_arrays_apart(docs)
    assert outputs["record"].count() == len(DOCS)
    assert {k: v.count() for k, v in outputs.items() if k != "record"} == {"contact": 7, "skill": 5, "hobby": 0}


def test_quoted_text(docs):
    out = flatten_json(docs, quoted=True)
    found = {r.record_id: r for r in out.filter("coalesce(contact_index, 0) = 0 and coalesce(skill_index, 0) = 0").collect()}
    assert found["0"].name == '"Al"' and found["0"].contact == '"c0"'
    assert found["1"].name is None and found["1"].address_zip == "1234"
    assert found["4"].name == "true" and found["6"].name is None and found["3"].contact is None


def test_routes(docs):
    outputs = route_all(docs, batch_id="b")
    assert rows(outputs["table1"], "record_id") == [("0",), ("4",), ("5",)]
    assert rows(outputs["table2"], "record_id") == [("2",), ("3",)]
    assert outputs["table1"].columns == ["record_id", "updated_at", "name", "address_city", "address_zip",
                                         "partition_date", "batch_id"]


def test_one_pass_routing_equals_separate_routes(docs):
    tagged = tag_targets(docs)
    for r in RECORD_ROUTES:
        one = route(docs, r)
        mine = tagged.filter(F.col("target_table") == r.target)
        assert rows(mine.select(*one.columns)) == rows(one)
        foreign = [c for c in RECORD_SCALARS if c not in r.scalars]
        assert mine.filter(" or ".join(f"{c} is not null" for c in foreign)).count() == 0
