"""The cleansing transformations.

Each is ``(frame, argument, context) -> frame``. Arguments are the short texts
used in properties documents; where a transformation is known by name only,
the argument format and the meaning below are this library's own choice.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from millrace.catalogue import Catalogue, load_catalogue
from millrace.functions.columns import mask_column
from millrace.operators.casting import cast_attributes, observe_failures
from millrace.session import work_path


@dataclass(frozen=True)
class CleansingContext:
    """What transformations may look up besides the frame."""

    catalogue: Catalogue | None = None
    catalogues: Mapping[str, Catalogue] = field(default_factory=dict)
    default_tz: str | None = None
    on_error: str = "null"
    properties_root: str | None = None
    #: Gets an observation for each cast step whose unreadable values are to be counted.
    cast_failures: list[Observation] | None = None

    def find(self, name: str) -> Catalogue:
        """By entity name, or by path: absolute, or below ``properties_root``."""
        for known, catalogue in self.catalogues.items():
            if known.lower() == name.lower():
                return catalogue
        if "/" in name and (name.startswith("/") or "://" in name):
            return load_catalogue(name)
        if "/" in name and self.properties_root:
            return load_catalogue(f"{self.properties_root.rstrip('/')}/{name}.properties")
        if self.catalogue is None:
            raise ValueError(f"no catalogue for {name!r}")
        return self.catalogue


def split_list(argument: str | Sequence[str]) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` as a clean list."""
    parts = argument.split(",") if isinstance(argument, str) else argument
    return [p.strip() for p in parts if p.strip()]


def split_pair(entry: str) -> tuple[str, str]:
    """``"left:right"`` cut at the first colon only: right parts hold colons."""
    left, colon, right = entry.partition(":")
    if not colon or not left.strip() or not right.strip():
        raise ValueError(f"expected 'name:value', got {entry!r}")
    return left.strip(), right.strip()


def _entries(argument: str | Sequence[str]) -> list[str]:
    return [argument] if isinstance(argument, str) else list(argument)


def _resolve(df: DataFrame, name: str) -> str:
    for column in df.columns:
        if column.lower() == name.strip().lower():
            return column
    raise ValueError(f"column {name!r} is not in the frame: {df.columns}")


def drop_duplicates(df: DataFrame, argument=True, context: CleansingContext | None = None) -> DataFrame:
    """Whole-row duplicates. Partial aggregation keeps hot rows off the shuffle."""
    return df.dropDuplicates()


def rename_attributes(df: DataFrame, argument, context: CleansingContext | None = None, strict: bool = False) -> DataFrame:
    """``"SRC:Target, SRC2:Target2"``; missing sources are ignored unless ``strict``."""
    pairs = argument if isinstance(argument, Mapping) else dict(split_pair(e) for e in split_list(argument))
    if strict:
        for source in pairs:
            _resolve(df, source)
    wanted = {source.lower(): target for source, target in pairs.items()}
    return df.select(*[F.col(f"`{c}`").alias(wanted.get(c.lower(), c)) for c in df.columns])


def remove_attributes(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"a, b"``; missing columns are ignored."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in split_list(argument)}])


def calculate_attribute(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"name:sql-expression"`` or a list of them, all seeing the same input."""
    computed = dict(split_pair(entry) for entry in _entries(argument))
    present = {c.lower(): c for c in df.columns}
    return df.withColumns({present.get(n.lower(), n): F.expr(e) for n, e in computed.items()})


def null_attributes(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"a, b"``: values become NULL, types stay."""
    wanted = {_resolve(df, name) for name in split_list(argument)}
    return df.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) if f.name in wanted else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def mask_attributes(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"a, b:sha2, c:redact"``; the default method is ``mask``."""
    masks = {}
    for entry in split_list(argument):
        name, _, method = entry.partition(":")
        column = _resolve(df, name)
        masks[column] = mask_column(F.col(f"`{column}`"), method.strip().lower() or "mask")
    return df.withColumns(masks)


def string_to_struct(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"col:k INT, v STRING"``: JSON text parsed in place with the given schema, or ``"col"``: with the merged schema of all rows.

    Text that is not JSON gives a NULL struct field by field. To merge the schema the
    column is read once, when the step is declared: numbers get a type that holds all of them, and a
    field whose kinds differ (number and text, object and array) is text. A column without JSON, or whose
    documents are not all objects or all arrays, stays text.
    """
    columns = {}
    for entry in _entries(argument):
        if ":" in entry:
            name, schema = split_pair(entry)
            column = _resolve(df, name)
        else:
            column = _resolve(df, entry)
            schema = json_schema(df, column)
        if schema:
            columns[column] = F.from_json(F.col(f"`{column}`"), schema)
    return df.withColumns(columns) if columns else df


_VARIANT_TYPES = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\b(?:VOID|VARIANT)\b(?!:)")


def json_schema(df: DataFrame, column: str) -> str | None:
    """The merged schema of a column of JSON text, as DDL; None where there is no common one.

    One aggregation, partial in each task; only the schema comes to the driver.
    """
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(f"`{column}`"))).alias("schema")).first()["schema"]
    if not merged.startswith(("OBJECT<", "ARRAY<")):
        return None
    types = {"OBJECT<": "STRUCT<", "VOID": "STRING", "VARIANT": "STRING"}
    return _VARIANT_TYPES.sub(lambda found: types.get(found[0], found[0]), merged)


def flatten_attribute(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"a, b"``: a struct becomes its fields, an array one row per element.

    Rows whose array is empty or NULL stay, with NULL. A field whose name is
    taken becomes ``column_field``.
    """
    for name in split_list(argument):
        column = _resolve(df, name)
        kind = df.schema[column].dataType
        if isinstance(kind, T.ArrayType):
            others = [F.col(f"`{c}`") for c in df.columns if c != column]
            df = df.select(*others, F.explode_outer(f"`{column}`").alias(column))
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            taken = {c.lower() for c in df.columns if c != column}
            projection = []
            for c in df.columns:
                if c != column:
                    projection.append(F.col(f"`{c}`"))
                    continue
                for f in kind.fields:
                    output = f"{column}_{f.name}" if f.name.lower() in taken else f.name
                    projection.append(F.col(f"`{column}`").getField(f.name).alias(output))
            df = df.select(*projection)
    return df


def _struct_path(kind: T.DataType, column: Column, path: list[str]) -> Column | None:
    for part in path:
        if not isinstance(kind, T.StructType):
            return None
        found = next((f for f in kind.fields if f.name.lower() == part.lower()), None)
        if found is None:
            return None
        kind, column = found.dataType, column.getField(found.name)
    return column


def _json_path(parts: Sequence[str]) -> str:
    return "$" + "".join(f"['{p}']" for p in parts)


def extract_optional(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"target:column.path.to.field"``: the value as text, NULL when the field is absent.

    The column may be a struct (the path need not exist in its schema), JSON
    text, or itself be missing from the frame.
    """
    columns = {}
    for entry in _entries(argument):
        target, source = split_pair(entry)
        root, *path = source.split(".")
        field_ = next((f for f in df.schema.fields if f.name.lower() == root.lower()), None)
        value: Column | None = None
        if field_ is not None:
            column = F.col(f"`{field_.name}`")
            if isinstance(field_.dataType, T.StringType) and path:
                value = F.get_json_object(column, _json_path(path))
            else:
                value = _struct_path(field_.dataType, column, path)
        columns[target] = (F.lit(None) if value is None else value).cast("string")
    return df.withColumns(columns)


# The names XML-to-JSON converters give an element's text.
_XML_TEXT_KEYS = ("#text", "_VALUE", "$")


def extract_json_value(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"target:column.path"`` on JSON that was made from XML.

    An element with attributes arrives as an object that holds its text under
    one of the usual keys; that text is preferred to the object. A path that
    starts with ``/`` is an XPath on raw XML: ``"target:column/a/b"``. ``"target:column<a INT, b ARRAY<STRING>>"`` is the
    whole XML document as a struct of that schema, ``"target:column<>"`` of the merged schema of all rows (``xml_struct``).
    """
    columns = {}
    for entry in _entries(argument):
        target, source = split_pair(entry)
        whole = re.match(r"([^./<]+)<(.*)>$", source, re.DOTALL)
        if whole:
            df = xml_struct(df, _resolve(df, whole[1]), target, whole[2].strip() or None, context)
            continue
        xml = re.match(r"([^./]+)(/.*)$", source)
        if xml:
            columns[target] = F.xpath_string(F.col(f"`{_resolve(df, xml[1])}`"), F.lit(xml[2]))
            continue
        root, *path = source.split(".")
        column = F.col(f"`{_resolve(df, root)}`")
        options = [F.get_json_object(column, _json_path([*path, key])) for key in _XML_TEXT_KEYS]
        columns[target] = F.coalesce(*options, F.get_json_object(column, _json_path(path)))
    return df.withColumns(columns) if columns else df


_UNREADABLE = "__unreadable"


def xml_schema(df: DataFrame, column: str) -> T.StructType | None:
    """The merged schema of a column of XML documents: an element that repeats in any of them is an array. None without documents.

    The documents that are well-formed are written once to the shared folder, one a line, and Spark's XML reader
    infers from all of them; their root elements must have one name.
    """
    path = work_path(df.sparkSession, "xml")
    text = F.col(f"`{column}`")
    # A document that breaks off would swallow those that follow it in the file.
    probe = F.from_xml(text, f"__none STRING, {_UNREADABLE} STRING", {"columnNameOfCorruptRecord": _UNREADABLE})
    whole = df.filter(text.isNotNull() & probe.getField(_UNREADABLE).isNull())
    whole.select(F.regexp_replace(text, r"[\r\n]+", " ").alias("value")).write.text(path)
    root = F.regexp_extract("value", r"<([A-Za-z_][^\s/>]*)", 1)
    lines = df.sparkSession.read.text(path)
    roots = [row[0] for row in lines.select(root.alias("root")).filter("root != ''").distinct().limit(2).collect()]
    if len(roots) > 1:
        raise ValueError(f"column {column!r} holds documents of several roots ({', '.join(sorted(roots))}, …): give a schema")
    if not roots:
        return None
    # The newer parser takes a file for one document and stops after the first.
    options = {"rowTag": roots[0], "mode": "DROPMALFORMED", "useLegacyXMLParser": "true"}
    found = df.sparkSession.read.options(**options).xml(path).schema
    return found if found.fields else None


def xml_struct(
    df: DataFrame, column: str, target: str, schema: str | T.StructType | None = None, context: CleansingContext | None = None
) -> DataFrame:
    """XML text as a typed struct ``target``: nested elements are structs, repeated ones arrays, attributes ``_name``.

    Without a schema the merged one of all rows is taken, which reads the column when the step is declared; a column without
    documents then gives NULL text. NULL, and a document that cannot be read in that schema, give a NULL struct; the
    latter are counted with the casts that failed, and stop the load with ``on_error="fail"``.
    """
    kind = xml_schema(df, column) if schema is None else T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if kind is None:
        return df.withColumn(target, F.lit(None).cast("string"))
    context = context or CleansingContext()
    fail = context.on_error == "fail"
    options = {"mode": "FAILFAST"} if fail else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE}
    read = kind if fail else T.StructType([*kind.fields, T.StructField(_UNREADABLE, T.StringType())])
    text = F.col(f"`{column}`")
    parsed = F.from_xml(text, read, options)
    if fail:
        return df.withColumn(target, parsed)
    df = df.withColumn(target, parsed)
    broken = F.col(f"`{target}`").getField(_UNREADABLE).isNotNull()
    if context.cast_failures is not None:
        context.cast_failures.append(Observation())
        df = df.observe(context.cast_failures[-1], F.count(F.when(broken, True)).alias(target))
    fields = F.struct(*[F.col(f"`{target}`").getField(f.name).alias(f.name) for f in kind.fields])
    return df.withColumn(target, F.when(F.col(f"`{target}`").isNotNull() & ~broken, fields))


def _order_terms(df: DataFrame, text: str) -> list[Column]:
    terms = []
    for entry in split_list(text):
        name, _, direction = entry.partition(" ")
        column = F.col(f"`{_resolve(df, name)}`")
        terms.append(column.asc_nulls_last() if direction.strip().lower() == "asc" else column.desc_nulls_last())
    return terms


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedupe_by_key(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"k1, k2"`` or ``"k1, k2:order1, order2 asc"``: the first row of each key.

    Orders are descending unless marked ``asc``; remaining ties are broken by
    all other columns, so the result does not depend on the input order. Spark
    limits each map task to one row per key before the shuffle, so a hot key
    costs no more than a cold one.
    """
    keys_text, _, order_text = argument.partition(":") if isinstance(argument, str) else (argument, "", "")
    keys = [_resolve(df, name) for name in split_list(keys_text)]
    if not keys:
        raise ValueError("DropDuplicatesByKey needs at least one key column")
    order = _order_terms(df, order_text)
    named = {entry.partition(" ")[0].lower() for entry in split_list(order_text)} | {k.lower() for k in keys}
    order += [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema.fields if f.name.lower() not in named and _orderable(f.dataType)
    ]
    if not order:
        return df.dropDuplicates(keys)
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def cast_step(df: DataFrame, argument, context: CleansingContext | None = None) -> DataFrame:
    """``"entity"``, ``"entity|Europe/London"`` or true for the job's own catalogue.

    A plain entity name must be the catalogue's own; that catches a step copied
    from another entity's document.
    """
    context = context or CleansingContext()
    name, zone = "", context.default_tz
    if isinstance(argument, str):
        name, bar, given = argument.partition("|")
        name = "" if name.strip().lower() == "true" else name.strip()
        zone = given.strip() if bar and given.strip() else zone
    if not name and context.catalogue is None:
        raise ValueError("CastAttributes needs a catalogue")
    catalogue = context.find(name) if name else context.catalogue
    expected = name if name and "/" not in name and catalogue.entity else None
    if context.cast_failures is not None and context.on_error == "null":
        context.cast_failures.append(Observation())
        df = observe_failures(df, catalogue, context.cast_failures[-1], zone)
    return cast_attributes(df, catalogue, zone, context.on_error, expected)


Transformation = Callable[[DataFrame, object, CleansingContext], DataFrame]

# The transformation names used in properties documents.
TRANSFORMATIONS: dict[str, Transformation] = {
    "DropDuplicates": drop_duplicates,
    "FlattenAttribute": flatten_attribute,
    "RenameAttributes": rename_attributes,
    "RemoveAttributes": remove_attributes,
    "CalculateAttribute": calculate_attribute,
    "ConvertStringToStructAttribute": string_to_struct,
    "MaskAttributes": mask_attributes,
    "NullAttributes": null_attributes,
    "ExtractValueFromOptionalAttribute": extract_optional,
    "ExtractValueFromJsonAttributeOfXmlSource": extract_json_value,
    "DropDuplicatesByKey": dedupe_by_key,
    "CastAttributes": cast_step,
}
