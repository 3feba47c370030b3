"""A mark's condition, carried through the declared steps to the raw rows.

A load keeps rows whose mark column is past the mark *after* all steps. Spark carries such a filter through
projections by itself, but neither through the observations that count rows and casts, nor
through a step that keeps one row of each key. Here the same steps are declared a second time on
the raw rows, without those that remove duplicates; the filter on their result is a filter on raw columns, as
Spark's optimizer sees through the projections, and reaches the scan. Where the mark comes from the
file's name or time, files behind it are not opened.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.operators.cleansing import TRANSFORMATIONS, CleansingContext, split_list, split_pair
from millrace.operators.pipeline import Steps, flatten_steps
from millrace.operators.watermark import HwmPolicy, filter_hwm

Step = tuple[str, object]

_BY_ROW = (
    "RenameAttributes", "RemoveAttributes", "CalculateAttribute", "NullAttributes", "MaskAttributes",
    "ExtractValueFromOptionalAttribute", "ExtractValueFromJsonAttributeOfXmlSource", "ConvertStringToStructAttribute",
    "CastAttributes",
)
# A calculation that looks at other rows or makes several of one: window functions and generators.
_OTHER_ROWS = re.compile(r"\bover\s*\(|\b(?:pos)?explode|\binline|\bstack\s*\(|\bjson_tuple|\bvariant_explode", re.IGNORECASE)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_RAW = "__raw"


def _texts(argument) -> list[str]:
    return [argument] if isinstance(argument, str) else [str(entry) for entry in argument]


def _by_row(step: Step) -> bool:
    """Whether a step makes one row of one row, from that row alone and without reading the frame first."""
    name, argument = step
    if name == "CalculateAttribute":
        return not any(_OTHER_ROWS.search(entry) for entry in _texts(argument))
    if name == "ConvertStringToStructAttribute":
        return all(":" in entry for entry in _texts(argument))
    if name == "ExtractValueFromJsonAttributeOfXmlSource":
        return not any(entry.rstrip().endswith("<>") for entry in _texts(argument))
    return name in _BY_ROW


def name_before(steps: Sequence[Step], column: str) -> str | None:
    """What ``column`` is called ahead of ``steps``, in lower case; None if a step may change its values or drop it."""
    name = column.lower()
    for step, argument in reversed(steps):
        if step == "RenameAttributes":
            pairs = argument.items() if hasattr(argument, "items") else [split_pair(e) for e in split_list(argument)]
            sources = [s.lower() for s, t in pairs if t.lower() == name]
            if len(sources) > 1 or (not sources and name in (s.lower() for s, _ in pairs)):
                return None
            name = sources[0] if sources else name
        elif step in ("NullAttributes", "MaskAttributes", "RemoveAttributes"):
            if name in (entry.partition(":")[0].strip().lower() for entry in split_list(argument)):
                return None
        elif step in _BY_ROW and step != "CastAttributes":
            if name in (entry.partition(":")[0].strip().lower() for entry in _texts(argument)):
                return None
        elif step not in ("DropDuplicates", "DropDuplicatesByKey"):
            return None
    return name


def _commutes(argument, later: Sequence[Step], frame: DataFrame, column: str) -> bool:
    """Whether keeping one row of each key may follow the choice by the mark.

    So if the mark is one of the keys, or if of each key the row with the latest mark is kept: no row of a key is past
    the mark unless that one is.
    """
    name = name_before(later, column)
    if name is None:
        return False
    keys, _, order = argument.partition(":") if isinstance(argument, str) else (argument, "", "")
    if name in (key.lower() for key in split_list(keys)):
        return True
    first, _, direction = (split_list(order) or [""])[0].partition(" ")
    kind = next((f.dataType for f in frame.schema.fields if f.name.lower() == name), None)
    return first.lower() == name and direction.strip().lower() != "asc" and isinstance(kind, _TIMES)


def past_mark(
    raw: DataFrame, steps: Steps, policy: HwmPolicy, mark: str, context: CleansingContext | None = None
) -> DataFrame:
    """The raw rows that can be past the mark after all ``steps``, columns as they are.

    All rows where the choice may not come first: a step that keeps one row of a key by something else than the mark, flattens,
    looks at other rows, reads the frame for a schema, or is not one of the library's; or a mark column the steps
    do not give. The mark must be a deterministic function of its row. The filter after the steps stays the one that decides.
    """
    if _RAW in raw.columns:
        return raw
    context = replace(context or CleansingContext(), cast_failures=None)
    pairs = flatten_steps(steps)
    frame = raw.select("*", F.struct("*").alias(_RAW))
    for place, (name, argument) in enumerate(pairs):
        if name == "DropDuplicates":
            continue
        if name == "DropDuplicatesByKey":
            if not _commutes(argument, pairs[place + 1 :], frame, policy.column):
                return raw
            continue
        if not _by_row((name, argument)):
            return raw
        frame = TRANSFORMATIONS[name](frame, argument, context)
    if _RAW not in frame.columns or policy.column.lower() not in (c.lower() for c in frame.columns):
        return raw
    return filter_hwm(frame, policy, mark).select(f"{_RAW}.*")
