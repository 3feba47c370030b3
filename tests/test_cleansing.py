from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import catalogue_from
from millrace.functions.columns import file_columns, hash_key, join_path
from millrace.operators import cleansing as c
from millrace.operators.pipeline import (
    apply_pipeline,
    find_actions,
    flatten_steps,
    order_warnings,
    register_action,
    register_transformation,
)
from millrace.operators.projection import add_audit_columns, add_extra_columns, add_history_columns, order_columns
from tests.conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "Ann", "x"), (1, "Ann", "x"), (2, None, "y"), (2, "Bob", None)], "id int, name string, note string")


def test_rename_can_be_strict(people):
    assert c.rename_attributes(people, "ID:Key, nope:x").columns == ["Key", "name", "note"]
    with pytest.raises(ValueError, match="nope"):
        c.rename_attributes(people, "nope:x", strict=True)


def test_rename_swaps_names(people):
    out = c.rename_attributes(people, "name:note, note:name")
    assert out.columns == ["id", "note", "name"]
    assert out.filter("note = 'Ann'").count() == 2


def test_calculate_splits_at_the_first_colon(people):
    out = c.calculate_attribute(people, "t:date_format(timestamp'2024-01-01 10:20:30', 'HH:mm:ss')")
    assert out.first()["t"] == "10:20:30"
    replaced = c.calculate_attribute(people, "NAME:upper(name)")
    assert replaced.columns == people.columns


def test_drop_duplicates_keeps_nulls_apart(people):
    assert c.drop_duplicates(people).count() == 3


def test_dedupe_by_key_is_deterministic(spark):
    data = [(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (2, None, "q")]
    expected = [(1, 5, "b"), (2, None, "q")]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k int, o int, v string").repartition(3)
        assert rows(c.dedupe_by_key(df, "k: o")) == expected
    df = spark.createDataFrame(data, "k int, o int, v string")
    assert rows(c.dedupe_by_key(df, "k: o desc, v asc")) == [(1, 5, "a"), (2, None, "q")]
    assert c.dedupe_by_key(df, "k").count() == 2


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = c.dedupe_by_key(df, "k: id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_null_mask_remove(people):
    assert c.null_attributes(people, "NAME").schema == people.schema
    assert c.null_attributes(people, "name").filter("name is not null").count() == 0
    assert c.mask_attributes(people, "name").first()["name"] == "Xxx"
    assert len(c.mask_attributes(people, "name:sha2").first()["name"]) == 64
    redacted = c.mask_attributes(people, "name:redact")
    assert {r["name"] for r in redacted.collect()} == {"***", None}
    with pytest.raises(ValueError, match="method"):
        c.mask_attributes(people, "name:rot13")
    assert c.remove_attributes(people, "Name, gone").columns == ["id", "note"]


def test_string_to_struct_and_flatten(spark):
    df = spark.createDataFrame([(1, '{"id": 7, "tags": ["a", "b"]}'), (2, "not json"), (3, None)], "id int, doc string")
    parsed = c.string_to_struct(df, "doc:id INT, tags ARRAY<STRING>")
    flat = c.flatten_attribute(parsed, "doc")
    assert flat.columns == ["id", "doc_id", "tags"]
    assert rows(c.flatten_attribute(flat, "tags").select("id", "doc_id", "tags")) == [
        (1, 7, "a"), (1, 7, "b"), (2, None, None), (3, None, None)]


def test_flatten_array_of_structs(spark):
    df = spark.sql("select 1 id, array(named_struct('a', 1), named_struct('a', 2)) items")
    assert rows(c.flatten_attribute(df, "items")) == [(1, 1), (1, 2)]
    assert c.flatten_attribute(df, "id").columns == df.columns


def test_extract_optional(spark):
    df = spark.sql("select named_struct('a', named_struct('b', 5)) s, '{\"a\": {\"b\": 6}}' j")
    out = c.extract_optional(df, ["x:s.a.b", "y:s.a.none", "z:j.a.b", "w:gone.a"])
    assert out.select("x", "y", "z", "w").first() == ("5", None, "6", None)


def test_extract_json_value(spark):
    df = spark.createDataFrame(
        [('{"r": {"v": {"#text": "t", "@id": "1"}, "w": "plain"}}', "<r><v>q</v></r>")], "j string, x string")
    out = c.extract_json_value(df, ["a:j.r.v", "b:j.r.w", "c:j.r.v.@id", "d:x/r/v", "e:j.none"])
    assert out.select("a", "b", "c", "d", "e").first() == ("t", "plain", "1", "q", None)


def test_json_schema_is_merged_over_all_rows(spark):
    data = ['{"a": 1, "o": {"x": [1, 2]}, "s": "t", "mixed": 1}', '{"a": 2.25, "o": {"x": [], "y": true}, "mixed": {"z": 1}}',
            '{"odd ` name": null, "VOID": "v"}', "no json", "", None]
    df = spark.createDataFrame(list(enumerate(data)), "id int, doc string")
    out = c.string_to_struct(df, "DOC")
    fields = {f.name: f.dataType.simpleString() for f in out.schema["doc"].dataType.fields}
    assert fields == {"a": "decimal(22,2)", "o": "struct<x:array<bigint>,y:boolean>", "s": "string", "mixed": "string",
                      "odd ` name": "string", "VOID": "string"}
    got = {r["id"]: r["doc"] for r in out.collect()}
    assert (float(got[0]["a"]), got[0]["o"]["x"], got[0]["mixed"], float(got[1]["a"])) == (1.0, [1, 2], "1", 2.25)
    assert (got[1]["mixed"], got[1]["o"]["y"], got[2]["VOID"]) == ('{"z":1}', True, "v")
    assert got[3]["a"] is None and got[5] is None
    for other in (["[1]", '{"a": 1}'], ["no json", None], ["1", "2"]):
        kept = spark.createDataFrame([(t,) for t in other], "doc string")
        assert rows(c.string_to_struct(kept, "doc")) == rows(kept)
    assert rows(c.string_to_struct(df.where("id < 0"), "doc")) == []


def test_xml_documents_become_structs(spark):
    data = ['<?xml version="1.0"?><r id="7"><v>1</v><p><q>x</q></p></r>', "<r><v>2</v>\n<v>3</v></r>", "<r><v>4</r>", "no xml", None]
    df = spark.createDataFrame(list(enumerate(data)), "id int, doc string")
    seen = []
    out = c.extract_json_value(df, "e:doc<>", c.CleansingContext(cast_failures=seen))
    assert out.columns == ["id", "doc", "e"]
    assert out.schema["e"].dataType.simpleString() == "struct<_id:bigint,p:struct<q:string>,v:array<bigint>>"
    got = {r["id"]: r["e"] for r in out.collect()}
    assert (got[0]["_id"], got[0]["v"], got[0]["p"]["q"]) == (7, [1], "x") and got[1]["v"] == [2, 3]
    assert got[2] is None and got[3] is None and got[4] is None
    assert [s.get for s in seen] == [{"e": 2}]
    typed = c.extract_json_value(df.where("id < 2"), "doc:doc<v ARRAY<STRING>, none DATE>")
    assert [r["doc"]["v"] for r in typed.sort("id").collect()] == [["1"], ["2", "3"]]
    with pytest.raises(Exception):
        c.extract_json_value(df, "e:doc<v ARRAY<INT>>", c.CleansingContext(on_error="fail")).collect()
    many = spark.createDataFrame([("<r><v>1</v></r>",), ("<r><v>1</v><v>2</v></r>",), ("<r><w>1</w></r>",)], "doc string").coalesce(1)
    assert c.xml_schema(many, "doc").simpleString() == "struct<v:array<bigint>,w:bigint>"
    two = spark.createDataFrame([("<a>1</a>",), ("<b>1</b>",)], "doc string")
    with pytest.raises(ValueError, match="several roots"):
        c.extract_json_value(two, "e:doc<>")
    for nothing in (df.where("id < 0"), df.where("id = 4"), df.where("id = 3")):
        assert {r["e"] for r in c.extract_json_value(nothing, "e:doc<>").collect()} <= {None}


def test_pipeline_forms_and_empty_arguments(people):
    assert flatten_steps({"NullAttributes": "name"}) == [("NullAttributes", "name")]
    assert flatten_steps([{"NullAttributes": ""}, {"RemoveAttributes": None}, {"DropDuplicates": "true"}]) == [
        ("DropDuplicates", "true")]
    out = apply_pipeline(people, [{"RenameAttributes": "id:Key"}, {"CalculateAttribute": "k2:Key * 2"}])
    assert out.columns == ["Key", "name", "note", "k2"]
    with pytest.raises(ValueError, match="Nope"):
        apply_pipeline(people, [{"Nope": "x"}])


def test_pipeline_warns_about_order():
    steps = [{"CastAttributes": "true"}, {"RenameAttributes": "a:b"}]
    assert order_warnings(steps) == ["CastAttributes comes before RenameAttributes"]
    assert order_warnings(steps[::-1]) == []


def test_own_transformations_and_actions(people):
    if "Shout" not in c.TRANSFORMATIONS:
        register_transformation("Shout", lambda df, arg, ctx: df.withColumn(arg, F.upper(arg)))
    assert apply_pipeline(people, {"Shout": "name"}).first()["name"] == "ANN"
    with pytest.raises(ValueError, match="exists"):
        register_transformation("Shout", lambda df, arg, ctx: df)
    register_action("only_ann", lambda df, job: df.filter("name = 'Ann'"))
    assert find_actions(["only_ann"])[0](people, None).count() == 2
    with pytest.raises(ValueError, match="missing"):
        find_actions(None)
    with pytest.raises(ValueError, match="not registered"):
        find_actions(["never"])


def test_order_columns_is_case_insensitive(people):
    catalogue = catalogue_from({"Catalogue": {"Schema": {"Attributes": [
        {"Name": "Note", "Type": "string", "OrdinalPosition": 2}, {"Name": "ID", "Type": "int", "OrdinalPosition": 1},
        {"Name": "gone", "Type": "int", "OrdinalPosition": 3}]}}})
    assert order_columns(people, catalogue).columns == ["ID", "Note"]


def test_audit_history_and_extra_columns_are_added_once(people):
    ts = "2024-01-01 00:00:00"
    once = add_history_columns(add_audit_columns(people, ts), ts)
    assert once.columns[-5:] == ["InsertedDateTime", "UpdatedDateTime", "EffectiveStartDate", "EffectiveEndDate", "IsActive"]
    assert add_history_columns(add_audit_columns(once, "2030-01-01"), "2030-01-01").first() == once.first()
    assert add_history_columns(people, ts).selectExpr("cast(EffectiveStartDate as string)").first()[0] == ts
    assert add_extra_columns(people, ["MemberType"]).first()["MemberType"] == "Standard"
    with pytest.raises(ValueError, match="unknown extra"):
        add_extra_columns(people, ["Type"])


def test_hash_key_null_marker(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = {r[0] for r in df.select(hash_key("x", "y", "z")).collect()}
    marked = {r[0] for r in df.select(hash_key("x", "y", "z", null_marker="~")).collect()}
    assert (len(plain), len(marked)) == (1, 2)


def test_file_columns_and_paths(spark):
    df = spark.createDataFrame([("s3://b/x/T_2024-03-31_1.csv",), ("/x/T_20240401.csv",), ("/x/plain.csv",)], "p string")
    got = [tuple(map(str, r)) for r in df.select(*[v.alias(k) for k, v in file_columns("p").items()]).collect()]
    assert [g[1:] for g in got] == [
        ("T_2024-03-31_1.csv", "2024-03-31", "2023"), ("T_20240401.csv", "2024-04-01", "2024"),
        ("plain.csv", "None", "None")]
    assert df.select(join_path("a", F.lit("b"), F.lit(None).cast("string"))).first()[0] is None
