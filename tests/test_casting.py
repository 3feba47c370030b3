from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from millrace.catalogue import Attribute, catalogue_from
from millrace.functions.types import resolve_type, same_type
from millrace.operators.casting import cast_attributes, cast_outcome, cast_report
from millrace.operators.cleansing import CleansingContext, cast_step
from tests.conftest import rows


@pytest.mark.parametrize("name, expected", [
    ("string", T.StringType()), ("NVARCHAR", T.StringType()), (" varchar ", T.StringType()), ("char", T.StringType()),
    ("bit", T.BooleanType()), ("Boolean", T.BooleanType()), ("bool", T.BooleanType()), ("date", T.DateType()),
    ("datetime", T.TimestampType()), ("datetimeoffset", T.TimestampType()), ("datetime2", T.TimestampType()),
    ("timestamp", T.TimestampType()), ("long", T.LongType()), ("bigint", T.LongType()), ("int", T.IntegerType()),
    ("integer", T.IntegerType()), ("double", T.DoubleType()), ("float", T.FloatType()),
    ("smallint", T.ShortType()), ("tinyint", T.ByteType()), ("geography", T.StringType()),
])
def test_type_names(name, expected):
    assert resolve_type(name) == expected


@pytest.mark.parametrize("precision, scale, expected", [
    (10, 2, (10, 2)), ("10", "2", (10, 2)), (10, 0, (10, 0)), (None, 2, (18, 6)), (10, None, (18, 6)),
    ("x", 2, (18, 6)), (60, 2, (18, 6)), (4, 6, (18, 6)),
])
def test_decimal_types(precision, scale, expected):
    assert resolve_type("numeric", precision, scale) == T.DecimalType(*expected)


def test_type_equality_looks_at_precision():
    assert same_type(T.StringType(), T.StringType())
    assert not same_type(T.DecimalType(10, 2), T.DecimalType(18, 6))


def test_scale_zero_is_taken_from_the_document():
    attribute = Attribute.from_mapping({"Name": "n", "Type": "decimal", "Precision": 9, "Scale": 0})
    assert attribute.data_type == T.DecimalType(9, 0)
    other = Attribute.from_mapping({"Name": "n", "Type": "decimal", "NumericPrecision": 9, "NumericScale": 3})
    assert other.data_type == T.DecimalType(9, 3)


def test_values_and_null_on_error(spark):
    df = spark.createDataFrame(
        [("1", "true", "2024-02-30", "3.14159"), ("x", "0", "2024-02-28", None)], "a string, b string, d string, p string")
    out = cast_attributes(df, [
        Attribute("a", "int"), Attribute("b", "bit"), Attribute("d", "date"), Attribute("p", "decimal", 5, 2)])
    assert rows(out) == rows(spark.createDataFrame(
        [(1, True, None, Decimal("3.14")), (None, False, dt.date(2024, 2, 28), None)],
        "a int, b boolean, d date, p decimal(5,2)"))


def test_fail_on_error(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_attributes(df, [Attribute("a", "int")], on_error="fail").collect()
    with pytest.raises(ValueError):
        cast_attributes(df, [Attribute("a", "int")], on_error="ignore")


def test_formats(spark):
    df = spark.createDataFrame([("28/02/2024", "2024-02-28 10:11:12", "bad")], "d string, t string, e string")
    out = cast_attributes(df, [
        Attribute("d", "date", format="dd/MM/yyyy"), Attribute("t", "datetime", format="yyyy-MM-dd HH:mm:ss"),
        Attribute("e", "datetime", format="yyyy"),
    ])
    assert out.selectExpr("d", "cast(t as string)", "e").first() == (dt.date(2024, 2, 28), "2024-02-28 10:11:12", None)


def test_formats_are_for_text_only(spark):
    df = spark.sql("select timestamp'2024-02-28 10:11:12' t, date'2024-02-28' d")
    out = cast_attributes(df, [Attribute("t", "date", format="dd/MM/yyyy"), Attribute("d", "datetime", format="dd/MM/yyyy")])
    assert out.selectExpr("cast(t as string)", "cast(d as string)").first() == ("2024-02-28", "2024-02-28 00:00:00")


def test_zone_applies_once_and_never_to_dates(spark):
    df = spark.createDataFrame([("2024-07-01 12:00:00", "2024-07-01")], "t string, d string")
    attributes = [Attribute("t", "datetime", timezone="Europe/London"), Attribute("d", "date", timezone="Europe/London")]
    once = cast_attributes(df, attributes)
    assert once.selectExpr("cast(t as string)", "cast(d as string)").first() == ("2024-07-01 13:00:00", "2024-07-01")
    twice = cast_attributes(once, attributes)
    assert twice.first() == once.first()
    asked = cast_attributes(once, attributes, shift_existing=True)
    assert asked.selectExpr("cast(t as string)").first()[0] == "2024-07-01 14:00:00"


def test_default_zone_and_precedence(spark):
    df = spark.createDataFrame([("2024-07-01 12:00:00",) * 2], "a string, b string")
    out = cast_attributes(
        df, [Attribute("a", "datetime"), Attribute("b", "datetime", timezone="America/New_York")], default_tz="Europe/London")
    assert out.selectExpr("cast(a as string)", "cast(b as string)").first() == ("2024-07-01 13:00:00", "2024-07-01 08:00:00")


def test_catalogue_case_wins_and_other_columns_stay(spark):
    df = spark.createDataFrame([("1", "keep")], "customerref string, other string")
    out = cast_attributes(df, [Attribute("CustomerRef", "string"), Attribute("Absent", "int")])
    assert out.columns == ["CustomerRef", "other"]


def test_outcome_counts(spark):
    df = spark.createDataFrame([("1", 2, "t")], "a string, b int, t string")
    outcome = cast_outcome(df, [
        Attribute("a", "int"), Attribute("b", "int"), Attribute("t", "datetime", timezone="UTC"), Attribute("z", "int")])
    assert (outcome.cast, outcome.unchanged, outcome.missing, outcome.expressions) == (["a", "t"], ["b"], ["z"], 3)


def test_report_counts_unreadable_values(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert rows(cast_report(df, [Attribute("a", "int")])) == [("a", 2, 1)]
    assert cast_report(df, [Attribute("a", "string")]).count() == 0


def test_one_projection_for_a_wide_frame(spark):
    names = [f"c{i}" for i in range(200)]
    df = spark.range(3).select(*[F.col("id").cast("string").alias(n) for n in names])
    out = cast_attributes(df, [Attribute(n, "int") for n in names])
    assert all(kind == "int" for _, kind in out.dtypes)
    assert out.agg(F.sum("c199")).first()[0] == 3


def test_entity_check(spark):
    document = {"Catalogue": {"Schema": {"Attributes": [{"Name": "a", "Type": "int"}]}}}
    catalogue = catalogue_from(document, "cleansed.Sales.Orders")
    df = spark.createDataFrame([("1",)], "a string")
    context = CleansingContext(catalogue=catalogue)
    assert cast_step(df, "CLEANSED.sales.orders", context).dtypes == [("a", "int")]
    assert cast_step(df, "true", context).dtypes == [("a", "int")]
    with pytest.raises(ValueError, match="declared for entity"):
        cast_step(df, "cleansed.sales.other", context)


def test_step_with_a_path_and_a_zone(spark, tmp_path):
    folder = tmp_path / "lake" / "cleansed"
    folder.mkdir(parents=True)
    (folder / "Orders.properties").write_text(
        '{"Catalogue": {"Schema": {"Attributes": [{"Name": "t", "Type": "datetime"}]}}}')
    df = spark.createDataFrame([("2024-07-01 12:00:00",)], "t string")
    context = CleansingContext(properties_root=str(tmp_path))
    (tmp_path / "definition").mkdir()
    out = cast_step(df, str(folder / "Orders.properties") + "|Europe/London", context)
    assert out.selectExpr("cast(t as string)").first()[0] == "2024-07-01 13:00:00"
    relative = cast_step(df, "lake/cleansed/Orders|Europe/London", context)
    assert relative.first() == out.first()


def test_missing_catalogue_section_raises():
    with pytest.raises(ValueError, match="Catalogue.Schema.Attributes"):
        catalogue_from({"System": {}})
