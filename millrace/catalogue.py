"""Entity configuration: properties documents, catalogue schema, entity lookup.

A properties document is a small JSON file, so it is handled as plain Python
on the driver; only data goes through DataFrames.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.types import resolve_type


def lookup(document: Mapping, path: str, default=None):
    """A nested value by dotted path, names compared without regard to case."""
    node = document
    for part in path.split("."):
        if not isinstance(node, Mapping):
            return default
        for name, value in node.items():
            if name.lower() == part.lower():
                node = value
                break
        else:
            return default
    return node


def as_flag(value, default: bool | None = False) -> bool | None:
    """Boolean-like settings: true, "True", "1", "yes"."""
    if value is None:
        return default
    if isinstance(value, bool):
        return value
    return str(value).strip().lower() in ("true", "1", "yes", "y")


def _first(mapping: Mapping, *names: str):
    for name in names:
        if mapping.get(name) is not None:
            return mapping[name]
    return None


@dataclass(frozen=True)
class Attribute:
    """One catalogue column."""

    name: str
    type_name: str = "string"
    precision: object = None
    scale: object = None
    format: str | None = None
    timezone: str | None = None
    position: int | None = None

    @property
    def data_type(self) -> T.DataType:
        return resolve_type(self.type_name, self.precision, self.scale)

    @staticmethod
    def from_mapping(entry: Mapping) -> "Attribute":
        position = entry.get("OrdinalPosition")
        return Attribute(
            name=str(entry.get("Name", "")).strip(),
            type_name=str(entry.get("Type", "")).strip(),
            precision=_first(entry, "Precision", "NumericPrecision"),
            scale=_first(entry, "Scale", "NumericScale"),
            format=entry.get("Format") or None,
            timezone=entry.get("Timezone") or None,
            position=None if position is None else int(position),
        )


@dataclass(frozen=True)
class Catalogue:
    """Ordered attributes, natural key and cleansing steps of one entity."""

    attributes: tuple[Attribute, ...]
    natural_key: tuple[str, ...] = ()
    transformations: tuple[Mapping, ...] = ()
    entity: str | None = None

    @property
    def ordered(self) -> list[Attribute]:
        """Attributes by OrdinalPosition; those without one keep their place at the end."""
        last = max((a.position for a in self.attributes if a.position is not None), default=0) + 1
        return sorted(self.attributes, key=lambda a: last if a.position is None else a.position)

    @property
    def column_names(self) -> list[str]:
        return [a.name for a in self.ordered]

    @property
    def schema(self) -> T.StructType:
        """The cleansed schema; formats and zones are kept as field metadata."""
        fields = []
        for attribute in self.ordered:
            notes = {"format": attribute.format, "timezone": attribute.timezone}
            metadata = {k: v for k, v in notes.items() if v}
            fields.append(T.StructField(attribute.name, attribute.data_type, True, metadata))
        return T.StructType(fields)


def catalogue_from(document: Mapping, entity: str | None = None) -> Catalogue:
    """The catalogue section of a properties document; raises when it is absent."""
    entries = lookup(document, "Catalogue.Schema.Attributes")
    if entries is None:
        raise ValueError("Catalogue.Schema.Attributes is missing from the properties document")
    attributes = tuple(a for a in map(Attribute.from_mapping, entries) if a.name and a.type_name)
    return Catalogue(
        attributes=attributes,
        natural_key=tuple(lookup(document, "Catalogue.Schema.NaturalKey", ())),
        transformations=tuple(lookup(document, "Extended.Cleanse.CleansingTransformations", ())),
        entity=entity or lookup(document, "EntityFullyQualifiedName"),
    )


def load_properties(source: str | Mapping, spark: SparkSession | None = None) -> dict:
    """A properties document from a mapping or from a path Spark can read."""
    if isinstance(source, Mapping):
        return dict(source)
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        raise ValueError("reading a properties file needs a SparkSession")
    row = spark.read.text(source, wholetext=True).head()
    if row is None:
        raise ValueError(f"properties file {source} is empty")
    return json.loads(row[0])


def load_catalogue(source: str | Mapping, spark: SparkSession | None = None, entity: str | None = None) -> Catalogue:
    """Catalogue of a properties document given as a mapping or a path."""
    return catalogue_from(load_properties(source, spark), entity)


def read_properties_frame(spark: SparkSession, paths: str | Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """Properties documents as a DataFrame: one row per document.

    ``fields`` maps output names to dotted paths, e.g.
    ``{"extension": "System.FileFormat.Extension"}``. ``extension`` also gives
    ``read_format``, the extension without its dot.

    The schema is that of all documents, inferred by as many tasks as read them: the reader's own
    inference would look up each file on the driver, one after the other.
    """

    def texts(row: T.Row) -> str:
        content = bytes(row[0])
        return content.decode(json.detect_encoding(content), "replace")

    contents = spark.read.text(paths, wholetext=True).select(F.col("value").cast("binary"))
    schema = spark.read.json(contents.rdd.map(texts)).schema
    documents = spark.read.schema(schema).option("multiLine", True).json(paths)
    frame = documents.select(*[F.col(path).alias(name) for name, path in fields.items()])
    if "extension" in fields:
        frame = frame.withColumn("read_format", F.regexp_replace("extension", r"\.", ""))
    return frame


@dataclass(frozen=True)
class FileFormat:
    """Reader settings of a raw entity, with the framework's defaults."""

    extension: str = ".csv"
    delimiter: str = ","
    header: bool = True
    escape: str = "\\"
    fail_fast: bool = True
    multiline: bool = True
    unescaped_quotes: str = "STOP_AT_DELIMITER"
    nul_interleaved: bool = False
    #: Whether many tasks read one file with line breaks inside fields; None: where a file is larger than one task's share.
    split_multiline: bool | None = None
    #: Of delimited text; None: UTF-8, and UTF-16LE where files are repaired.
    encoding: str | None = None

    @property
    def read_format(self) -> str:
        return self.extension.replace(".", "").lower()

    @staticmethod
    def from_document(document: Mapping) -> "FileFormat":
        section = lookup(document, "System.FileFormat")
        if section is None:
            raise ValueError("System.FileFormat is missing from the properties document")
        base = FileFormat()
        return FileFormat(
            extension=lookup(section, "Extension", base.extension),
            delimiter=lookup(section, "ColumnDelimiter", base.delimiter),
            header=as_flag(lookup(section, "Header"), base.header),
            escape=lookup(section, "Escape", base.escape),
            fail_fast=as_flag(lookup(section, "FailFast"), base.fail_fast),
            multiline=as_flag(lookup(section, "MultiLine"), base.multiline),
            unescaped_quotes=lookup(section, "UnescapedQuoteHandling", base.unescaped_quotes),
            nul_interleaved=as_flag(lookup(section, "StripEvenCharactersFromRawFile"), False),
            split_multiline=as_flag(lookup(section, "SplitMultiLine"), None),
            encoding=lookup(section, "Encoding") or None,
        )


@dataclass(frozen=True)
class EntityRegistry:
    """Entity names and where their files and properties live."""

    entries: Mapping[str, Mapping] = field(default_factory=dict)

    @staticmethod
    def from_frame(frame: DataFrame, name: str = "EntityFullyQualifiedName") -> "EntityRegistry":
        """From a configuration table with one row per entity (small by nature)."""
        return EntityRegistry({row[name].lower(): row.asDict() for row in frame.toLocalIterator()})

    def find(self, entity: str) -> Mapping:
        try:
            return self.entries[entity.strip().lower()]
        except KeyError:
            raise KeyError(f"entity {entity!r} is not registered") from None
