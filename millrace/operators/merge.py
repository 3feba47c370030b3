"""History (SCD type 2) and current-state (SCD type 1) merges as DataFrame plans.

Only active versions meet the batch; history passes by. Each active version looks
its key up in the batch, and a second scan of keys and compared columns finds the
keys that stay active; batch rows without one are new. The rows are the same at
every batch size and with any number of active versions of a key.

A ``strategy`` names a join method, never other rows: under ``auto`` (or
``lookup``) the planner decides from real sizes whether to broadcast the batch, in
which case the table is not shuffled; ``merge`` asks for a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.columns import time_literal
from millrace.functions.predicates import (
    DEFAULT_EXCLUDE,
    change_columns,
    changed,
    changed_plain,
    expired_before,
    is_active,
    is_closed,
)
from millrace.operators.cleansing import dedupe_by_key
from millrace.operators.projection import ACTIVE, END, START, UPDATED, add_history_columns

OUTCOME = "merge_outcome"
KEPT, EXPIRED, INSERTED = "unchanged", "expired", "inserted"
UPDATED_ROW = "updated"

# Columns an update never overwrites.
UPSERT_EXCLUDE = ("InsertedDateTime", "EffectiveStartDate")

_SINK, _BATCH, _STAMP = "_sink", "_batch", "_stamp"


# Projections of hundreds of columns are written as SQL text: each Column object
# costs the driver calls into the JVM, a list of texts costs one.


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(name: str) -> Column:
    return F.col(_name(name))


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, without regard to case; absent ones are NULL.

    Raises on columns the schema does not know: they would be lost.
    """
    present = {c.lower(): c for c in df.columns}
    surplus = set(present) - {f.name.lower() for f in schema.fields}
    if surplus:
        raise ValueError(f"columns {sorted(present[c] for c in surplus)} are not in the target table")
    types = {f.name: f.dataType for f in df.schema.fields}
    projection = []
    for f in schema.fields:
        source = present.get(f.name.lower())
        value = "NULL" if source is None else _name(source)
        if source is None or types[source] != f.dataType:
            value = f"CAST({value} AS {f.dataType.simpleString()})"
        projection.append(f"{value} AS {_name(f.name)}")
    return df.selectExpr(*projection)


def _resolve_keys(schema: T.StructType, keys: Sequence[str]) -> list[str]:
    names = {f.name.lower(): f.name for f in schema.fields}
    if not keys:
        raise ValueError("a merge needs at least one key column")
    absent = [k for k in keys if k.lower() not in names]
    if absent:
        raise ValueError(f"key columns {absent} are not in the target table")
    return [names[k.lower()] for k in keys]


def _any_null(keys: Sequence[str]) -> Column:
    test = _quoted(keys[0]).isNull()
    for key in keys[1:]:
        test = test | _quoted(key).isNull()
    return test


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Pass rows through; stop the job at the second row of a key.

    ``row_number`` streams over rows already grouped by key, so beside a join
    on the same keys this costs neither another shuffle nor another sort.
    """
    columns = [_quoted(k) for k in keys]
    place = F.row_number().over(Window.partitionBy(*columns).orderBy(*columns))
    shown = F.concat_ws(", ", *[c.cast("string") for c in columns])
    stop = F.raise_error(F.concat(F.lit(f"duplicate key in {what}: "), shown))
    numbered = df.withColumn("_place", place)
    return numbered.filter(F.when(F.col("_place") > 1, stop).isNull()).drop("_place")


def prepare_batch(
    batch: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    duplicates: str | Sequence[str] = "fail",
    null_keys: str = "insert",
) -> tuple[DataFrame, DataFrame | None]:
    """The batch in table shape, split into rows with a key and rows without.

    ``duplicates``: ``"fail"`` or columns to order by, the last row of each key
    being kept. ``null_keys``: a NULL key never matches, so such rows are
    inserted on every run (``"insert"``), left out (``"quarantine"``, see
    :func:`quarantined`), or stop the job (``"fail"``). Rows without a key do
    not enter the join, where they would all land in one task.
    """
    if null_keys not in ("insert", "quarantine", "fail"):
        raise ValueError("null_keys must be 'insert', 'quarantine' or 'fail'")
    batch = align(batch, schema)
    missing = _any_null(keys)
    keyed = batch.filter(~missing)
    if null_keys == "fail":
        stop = F.raise_error(F.lit(f"NULL in key columns {list(keys)}"))
        keyed = batch.filter(F.when(missing, stop).isNull())
    if duplicates == "fail":
        keyed = assert_unique(keyed, keys, "the batch")
    else:
        order = [duplicates] if isinstance(duplicates, str) else list(duplicates)
        keyed = dedupe_by_key(keyed, f"{', '.join(keys)}:{', '.join(order)}")
    return keyed, batch.filter(missing) if null_keys == "insert" else None


def quarantined(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch rows that ``null_keys="quarantine"`` leaves out."""
    return batch.filter(_any_null(keys))


def _prefixed(df: DataFrame, prefix: str, columns: Iterable[str] | None = None) -> DataFrame:
    # Few calls for many columns: building a wide plan is work for the driver.
    names = list(columns) if columns is not None else df.columns
    chosen = df if columns is None else df.select(*[_name(c) for c in names])
    return chosen.toDF(*[f"{prefix}.{c}" for c in names]).withColumn(prefix, F.lit(True))


def _text(prefix: str, column: str) -> str:
    return _name(f"{prefix}.{column}")


def _of(prefix: str, column: str) -> Column:
    return F.col(_text(prefix, column))


def _on(keys: Sequence[str]) -> Column:
    condition = _of(_SINK, keys[0]) == _of(_BATCH, keys[0])
    for key in keys[1:]:
        condition = condition & (_of(_SINK, key) == _of(_BATCH, key))
    return condition


def _pairs(columns: Iterable[str]) -> list[tuple[Column, Column]]:
    return [(_of(_SINK, c), _of(_BATCH, c)) for c in columns]


def _looked_up_by(batch: DataFrame, strategy: str) -> DataFrame:
    """The batch as the side that is looked up. A strategy is a join method; the rows are the same under each."""
    if strategy in ("auto", "lookup"):
        return batch  # the planner decides from real sizes
    if strategy in ("merge", "outer"):  # "outer" is its former name
        return batch.hint("merge")
    raise ValueError("strategy must be 'auto', 'lookup' or 'merge'")


def _differences(columns: Iterable[str]) -> list[str]:
    return [f"NOT ({_text(_SINK, c)} <=> {_text(_BATCH, c)})" for c in columns]


def _changed(columns: Iterable[str]) -> Column:
    """NULL-safe: true when any compared column differs."""
    return F.expr(" OR ".join(_differences(columns)))


def _same(columns: Iterable[str]) -> Column:
    """True when no compared column differs, as one opaque value.

    A plain list of ``<=>`` terms above a join would become join keys, hashed
    for every row; this is looked at only where the keys match.
    """
    return F.expr(f"NOT array_contains(array({', '.join(_differences(columns))}), true)")


def _stay_or_expire(schema: T.StructType) -> list[str]:
    """The sink row after the merge: closed when it expired, else as it was."""
    closing = {END.lower(): _STAMP, ACTIVE.lower(): "false", UPDATED.lower(): _STAMP}
    columns = []
    for f in schema.fields:
        value, new = _text(_SINK, f.name), closing.get(f.name.lower())
        if new is not None:
            new = f"CAST({new} AS {f.dataType.simpleString()})"
            value = f"CASE WHEN {OUTCOME} = '{EXPIRED}' THEN {new} ELSE {value} END"
        columns.append(value)
    return columns


def merge_active(
    active: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    run_ts=None,
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    duplicates: str | Sequence[str] = "fail",
    null_keys: str = "insert",
    strategy: str = "auto",
) -> DataFrame:
    """Active versions after the merge plus those it closed.

    Columns of ``active`` plus ``merge_outcome``: unchanged, expired, inserted.
    """
    schema = active.schema
    keys = _resolve_keys(schema, keys)
    compared = change_columns(schema.names, keys, exclude)
    keyed, keyless = prepare_batch(add_history_columns(batch, run_ts), schema, keys, duplicates, null_keys)
    result = _merge_lookup(active, keyed, keys, compared, run_ts, strategy)
    if keyless is not None:
        result = result.unionByName(keyless.withColumn(OUTCOME, F.lit(INSERTED)))
    return result


def _merge_lookup(active: DataFrame, batch: DataFrame, keys, compared, run_ts, strategy: str) -> DataFrame:
    """Each active version looks its key up in the batch; batch rows without an equal active version are new.

    A key may have any number of active versions. Both joins keep the side
    where keys repeat on the left, which Spark can split.
    """
    schema = active.schema
    needed = [*keys, *compared]
    sought = _looked_up_by(_prefixed(batch, _BATCH, needed), strategy)
    looked_up = _prefixed(active, _SINK).join(sought, _on(keys), "left")
    is_changed = F.col(_BATCH).isNotNull() & _changed(compared)
    told = looked_up.withColumn(OUTCOME, F.when(is_changed, F.lit(EXPIRED)).otherwise(F.lit(KEPT)))
    after = told.withColumn(_STAMP, time_literal(run_ts)).selectExpr(*[
        f"{staying} AS {_name(n)}" for n, staying in zip(schema.names, _stay_or_expire(schema))
    ], OUTCOME)
    still_active = (
        _prefixed(active, _SINK, needed)
        .join(sought, _on(keys), "inner")
        .filter(_same(compared))
        .select(*[_of(_BATCH, k).alias(k) for k in keys])
        .distinct()
    )
    new = batch.join(still_active, list(keys), "left_anti").select(*schema.names)
    return after.unionByName(new.withColumn(OUTCOME, F.lit(INSERTED)))


def scd2_merge(
    sink: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    run_ts=None,
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    duplicates: str | Sequence[str] = "fail",
    null_keys: str = "insert",
    strategy: str = "auto",
    with_outcome: bool = False,
) -> DataFrame:
    """The whole history table after merging a batch of current rows.

    Changed keys get their active version closed (inactive, end date and
    update time set to ``run_ts``) and a new active version; new keys get a
    first version; unchanged keys and keys absent from the batch stay as they
    are. Comparison is NULL-safe over the table's columns minus ``exclude``.
    """
    active = sink.filter(is_active(ACTIVE))
    past = sink.filter(is_closed(ACTIVE))
    merged = merge_active(active, batch, keys, run_ts, exclude, duplicates, null_keys, strategy)
    if not with_outcome:
        return merged.drop(OUTCOME).unionByName(past)
    return merged.unionByName(past.withColumn(OUTCOME, F.lit("history")))


def scd2_expire(sink: DataFrame, batch: DataFrame, keys: Sequence[str], run_ts=None, **options) -> DataFrame:
    """First pass alone: the table with the active versions of changed keys closed."""
    merged = scd2_merge(sink, batch, keys, run_ts, with_outcome=True, **options)
    return merged.filter(F.col(OUTCOME) != INSERTED).drop(OUTCOME)


def scd2_insert(
    sink: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    run_ts=None,
    duplicates: str | Sequence[str] = "fail",
    null_keys: str = "insert",
) -> DataFrame:
    """Second pass alone: batch rows whose key has no active version in ``sink``."""
    keys = _resolve_keys(sink.schema, keys)
    batch = add_history_columns(batch, run_ts)
    keyed, keyless = prepare_batch(batch, sink.schema, keys, duplicates, null_keys)
    active_keys = sink.filter(is_active(ACTIVE)).select(*keys).distinct()
    new = keyed.join(active_keys, keys, "left_anti").select(*sink.columns)
    return new if keyless is None else new.unionByName(keyless)


def find_changes(
    sink: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    null_safe: bool = True,
) -> DataFrame:
    """Keys whose active version differs from the batch."""
    keys = _resolve_keys(sink.schema, keys)
    active = sink.filter(is_active(ACTIVE)) if ACTIVE in sink.columns else sink
    known = {c.lower() for c in batch.columns}
    compared = change_columns([c for c in sink.columns if c.lower() in known], keys, exclude)
    needed = [*keys, *compared]
    sides = _prefixed(active, _SINK, needed).join(_prefixed(batch, _BATCH, needed), _on(keys), "inner")
    test = changed(_pairs(compared)) if null_safe else changed_plain(_pairs(compared))
    return sides.filter(test).select(*[_of(_SINK, k).alias(k) for k in keys])


def scd2_metrics(
    sink: DataFrame, batch: DataFrame, keys: Sequence[str], run_ts=None, **options
) -> DataFrame:
    """One row: how many versions a merge expires, inserts and leaves unchanged."""
    active = sink.filter(is_active(ACTIVE))
    return outcome_counts(merge_active(active, batch, keys, run_ts, **options))


def outcome_counts(merged: DataFrame) -> DataFrame:
    """Counts by outcome from a merge result; one partial row per task is shuffled."""
    return merged.agg(*[count_outcome(name) for name in (EXPIRED, INSERTED, KEPT)])


def scd1_upsert(
    sink: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    exclude: Iterable[str] = UPSERT_EXCLUDE,
    duplicates: str | Sequence[str] = "fail",
    null_keys: str = "insert",
    with_outcome: bool = False,
) -> DataFrame:
    """Update matched rows from the batch, insert the rest.

    Columns in ``exclude`` and columns the batch lacks keep the table's value
    on an update. The table may hold several rows of a key: a left join, unlike
    a full outer one, lets Spark split a hot key or broadcast a small batch.
    Rows without a key pass by the joins.
    """
    schema = sink.schema
    keys = _resolve_keys(schema, keys)
    given = {c.lower() for c in batch.columns} - {c.lower() for c in exclude} - {k.lower() for k in keys}
    taken = [f.name for f in schema.fields if f.name.lower() in given]
    keyed, keyless = prepare_batch(batch, schema, keys, duplicates, null_keys)
    missing = _any_null(keys)
    present = sink.filter(~missing)
    looked_up = _prefixed(present, _SINK).join(_prefixed(keyed, _BATCH, [*keys, *taken]), _on(keys), "left")
    updated = looked_up.selectExpr(*[
        f"CASE WHEN {_BATCH} THEN {_text(_BATCH, n)} ELSE {_text(_SINK, n)} END AS {_name(n)}"
        if n in taken else f"{_text(_SINK, n)} AS {_name(n)}"
        for n in schema.names
    ], f"CASE WHEN {_BATCH} THEN '{UPDATED_ROW}' ELSE '{KEPT}' END AS {OUTCOME}")
    new = keyed.join(present.select(*keys).distinct(), keys, "left_anti").select(*schema.names)
    added = new if keyless is None else new.unionByName(keyless)
    result = updated.unionByName(added.withColumn(OUTCOME, F.lit(INSERTED)))
    result = result.unionByName(sink.filter(missing).withColumn(OUTCOME, F.lit(KEPT)))
    return result if with_outcome else result.drop(OUTCOME)


def scd1_metrics(sink: DataFrame, batch: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """One row: how many rows an upsert updates, inserts and leaves unchanged."""
    merged = scd1_upsert(sink, batch, keys, with_outcome=True, **options)
    return merged.agg(*[count_outcome(name) for name in (UPDATED_ROW, INSERTED, KEPT)])


def count_outcome(name: str) -> Column:
    return F.count(F.when(F.col(OUTCOME) == name, True)).alias(name)


def append_all(sink: DataFrame, batch: DataFrame, run_ts=None) -> DataFrame:
    """Table plus every batch row as a new version, matched or not."""
    return sink.unionByName(align(add_history_columns(batch, run_ts), sink.schema))


def current_versions(sink: DataFrame) -> DataFrame:
    """Active versions only."""
    return sink.filter(is_active(ACTIVE))


def retention_purge(sink: DataFrame, days: int, run_ts=None) -> DataFrame:
    """The table without inactive versions that ended before the retention window."""
    return sink.filter(~F.coalesce(expired_before(days, run_ts, ACTIVE, END), F.lit(False)))


def merge_into(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    run_ts=None,
    exclude: Iterable[str] = DEFAULT_EXCLUDE,
    duplicates: str | Sequence[str] = "fail",
) -> None:
    """The same merge on a table format with row-level operations (Delta, Iceberg).

    Two ``MERGE`` statements through the DataFrame API with the same predicates:
    close what changed, then insert keys without an active version.
    """
    spark = batch.sparkSession
    schema = spark.table(table).schema
    keys = _resolve_keys(schema, keys)
    compared = change_columns(schema.names, keys, exclude)
    keyed, keyless = prepare_batch(add_history_columns(batch, run_ts), schema, keys, duplicates)
    if keyless is not None:
        keyed = keyed.unionByName(keyless)
    source = keyed.alias("source")
    stamp = time_literal(run_ts)

    def sink_column(name: str) -> Column:
        return F.col(f"{table}.`{name}`")

    condition = sink_column(ACTIVE) == F.lit(True)
    for key in keys:
        condition = condition & (sink_column(key) == F.col(f"source.`{key}`"))
    difference = changed((sink_column(c), F.col(f"source.`{c}`")) for c in compared)
    closing = {END: stamp, ACTIVE: F.lit(False)}
    if UPDATED in schema.names:
        closing[UPDATED] = stamp
    source.mergeInto(table, condition).whenMatched(difference).update(closing).merge()
    source.mergeInto(table, condition).whenNotMatched().insertAll().merge()


__all__ = [
    "ACTIVE", "END", "EXPIRED", "INSERTED", "KEPT", "OUTCOME", "START", "UPSERT_EXCLUDE",
    "align", "append_all", "assert_unique", "current_versions", "find_changes", "merge_active",
    "merge_into", "outcome_counts", "prepare_batch", "quarantined",
    "count_outcome", "UPDATED_ROW", "retention_purge", "scd1_metrics", "scd1_upsert", "scd2_expire", "scd2_insert", "scd2_merge", "scd2_metrics",
]
