"""Casting to the catalogue schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from millrace.catalogue import Attribute, Catalogue
from millrace.functions.types import same_type


@dataclass
class CastOutcome:
    """What a cast did, decided from the schemas alone."""

    cast: list[str] = field(default_factory=list)
    unchanged: list[str] = field(default_factory=list)
    missing: list[str] = field(default_factory=list)
    expressions: int = 0


def _attributes(catalogue: Catalogue | Sequence[Attribute]) -> list[Attribute]:
    return list(catalogue.attributes if isinstance(catalogue, Catalogue) else catalogue)


def _to_type(column: Column, source: T.DataType, attribute: Attribute, lenient: bool) -> Column:
    target = attribute.data_type
    # A format says how text is written; dates and times are cast as they are.
    if attribute.format and isinstance(source, T.StringType):
        if isinstance(target, T.DateType):
            return F.try_to_date(column, attribute.format) if lenient else F.to_date(column, attribute.format)
        if isinstance(target, T.TimestampType):
            pattern = F.lit(attribute.format)
            return F.try_to_timestamp(column, pattern) if lenient else F.to_timestamp(column, attribute.format)
    return column.try_cast(target) if lenient else column.cast(target)


def _plan(
    schema: T.StructType,
    attributes: Sequence[Attribute],
    default_tz: str | None,
    on_error: str,
    shift_existing: bool,
) -> tuple[dict[str, tuple[str, Column]], CastOutcome]:
    """Per frame column (lower case): its output name and expression."""
    if on_error not in ("null", "fail"):
        raise ValueError("on_error must be 'null' or 'fail'")
    present = {f.name.lower(): f for f in schema.fields}
    outcome = CastOutcome()
    planned: dict[str, tuple[str, Column]] = {}
    for attribute in attributes:
        found = present.get(attribute.name.lower())
        if found is None:
            outcome.missing.append(attribute.name)
            continue
        target = attribute.data_type
        column = F.col(f"`{found.name}`")
        matches = same_type(found.dataType, target)
        expression = column if matches else _to_type(column, found.dataType, attribute, on_error == "null")
        zone = (attribute.timezone or default_tz) if isinstance(target, T.TimestampType) else None
        # A column that already was a timestamp has been shifted by an earlier
        # run as far as we can tell; shifting it again would move the instant.
        shift = zone is not None and (not matches or shift_existing)
        if shift:
            expression = F.from_utc_timestamp(expression, zone)
        if matches and not shift:
            outcome.unchanged.append(attribute.name)
        else:
            outcome.cast.append(attribute.name)
            outcome.expressions += int(not matches) + int(shift)
        planned[found.name.lower()] = (attribute.name, expression)
    return planned, outcome


def check_entity(expected: str | None, actual: str | None) -> None:
    """Raise unless both name the same entity, without regard to case."""
    if expected is None:
        return
    if actual is None or expected.strip().lower() != actual.strip().lower():
        raise ValueError(f"cast declared for entity {expected!r} but the catalogue belongs to {actual!r}")


def cast_outcome(
    df: DataFrame,
    catalogue: Catalogue | Sequence[Attribute],
    default_tz: str | None = None,
    shift_existing: bool = False,
) -> CastOutcome:
    """Which columns a cast would change, leave or miss. Reads no data."""
    return _plan(df.schema, _attributes(catalogue), default_tz, "null", shift_existing)[1]


def cast_attributes(
    df: DataFrame,
    catalogue: Catalogue | Sequence[Attribute],
    default_tz: str | None = None,
    on_error: str = "null",
    expected_entity: str | None = None,
    shift_existing: bool = False,
) -> DataFrame:
    """Cast every catalogue column that the frame has, in one projection.

    Column names are matched without regard to case and come out in catalogue
    case; other columns pass unchanged. Times are shifted from UTC to the
    column's zone, else ``default_tz``, else not at all; dates never. With
    ``on_error="null"`` unreadable values become NULL, with ``"fail"`` the job
    stops. A column that already is a timestamp is shifted only when
    ``shift_existing`` is set, so casting twice equals casting once.
    """
    check_entity(expected_entity, catalogue.entity if isinstance(catalogue, Catalogue) else None)
    planned, _ = _plan(df.schema, _attributes(catalogue), default_tz, on_error, shift_existing)
    projection = []
    for name in df.columns:
        output, expression = planned.get(name.lower(), (name, F.col(f"`{name}`")))
        projection.append(expression.alias(output))
    return df.select(*projection)


def observe_failures(
    df: DataFrame, catalogue: Catalogue | Sequence[Attribute], seen: Observation, default_tz: str | None = None
) -> DataFrame:
    """The frame itself; whoever runs it learns in ``seen``, for each cast column, how many values the cast cannot read."""
    planned, outcome = _plan(df.schema, _attributes(catalogue), default_tz, "null", False)
    by_name = {output: (raw, expression) for raw, (output, expression) in planned.items()}
    lost = [
        F.count(F.when(F.col(f"`{by_name[n][0]}`").isNotNull() & by_name[n][1].isNull(), True)).alias(n) for n in outcome.cast
    ]
    return df.observe(seen, F.count(F.lit(1)).alias("_rows"), *lost)


def cast_report(df: DataFrame, catalogue: Catalogue | Sequence[Attribute]) -> DataFrame:
    """Per cast column: values present, and values the cast cannot read.

    One aggregate over one scan; map-side partial sums leave a single row per
    task to shuffle, however wide the table is.
    """
    planned, outcome = _plan(df.schema, _attributes(catalogue), None, "null", False)
    by_name = {output: (raw, expression) for raw, (output, expression) in planned.items()}
    entries = []
    for name in outcome.cast:
        raw, expression = by_name[name]
        given = F.col(f"`{raw}`").isNotNull()
        present = F.coalesce(F.sum(given.cast("bigint")), F.lit(0))
        failed = F.coalesce(F.sum((given & expression.isNull()).cast("bigint")), F.lit(0))
        entries.append(F.struct(
            F.lit(name).alias("column_name"), present.alias("present"), failed.alias("failed"),
        ))
    schema = "column_name string, present bigint, failed bigint"
    if not entries:
        return df.sparkSession.createDataFrame([], schema)
    return df.agg(F.array(*entries).alias("entries")).selectExpr("inline(entries)")
