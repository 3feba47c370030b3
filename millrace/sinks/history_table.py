"""A history table in plain Parquet folders.

Plain Parquet has no MERGE and no DELETE, so every load writes a new folder and
then publishes it by creating the next pointer file:

``load_id=<n>-<x>/IsActive=true/…``                 all active versions after load n
``load_id=<n>-<x>/IsActive=false/EndMonth=<m>/…``   versions closed by load n
``_pointer/<n>.json``                               what readers see

A load rewrites the active versions only; closed versions are written once and
never again. Readers use the newest pointer, so a failed load leaves nothing
visible, and two loads cannot publish the same number. Retention is a change of
the pointer: months before the cutoff are let go unread, and the month it falls
into is filtered by day. Where a table format with row-level operations is
installed, use ``merge_into`` instead.

A table may be laid out in partitions below ``EndMonth``: by ``KeyHash``, a hash of its keys into a given number of
buckets, or by columns of its own (``partition_by``). Then a load reads and rewrites only those active partitions that
its batch touches: the buckets of the batch's keys, or the partitions its rows belong to and those in which its
keys lie so far. All others stay as they are, named by the new pointer. Rows without a key have a bucket of
their own, which is only added to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.operators.merge import EXPIRED, INSERTED, KEPT, OUTCOME, count_outcome, merge_active
from millrace.operators.projection import ACTIVE, END, HISTORY_COLUMNS, INSERTED as INSERTED_TS, START, UPDATED
from millrace.sinks import folders

_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_LOAD, _MONTH, _BUCKET = "load_id", "EndMonth", "KeyHash"
_OPEN_FILES = "16"
#: Buckets and partitions that one load may touch: their names come to the driver.
MOST_PARTITIONS = 100_000


@dataclass(frozen=True)
class MergeCounts:
    """Rows a merge expired, inserted and left unchanged."""

    expired: int = 0
    inserted: int = 0
    unchanged: int = 0
    updated: int = 0

    @property
    def affected(self) -> int:
        return self.expired + self.inserted + self.updated

    def __add__(self, other: "MergeCounts") -> "MergeCounts":
        return MergeCounts(
            self.expired + other.expired, self.inserted + other.inserted,
            self.unchanged + other.unchanged, self.updated + other.updated,
        )


def history_schema(schema: T.StructType, audit: bool = True) -> T.StructType:
    """A catalogue schema plus the audit and history columns it does not list."""
    listed = {f.name.lower() for f in schema.fields}
    extra = [(INSERTED_TS, T.TimestampType()), (UPDATED, T.TimestampType())] if audit else []
    extra += [(START, T.TimestampType()), (END, T.TimestampType()), (ACTIVE, T.BooleanType())]
    return T.StructType(schema.fields + [T.StructField(n, t) for n, t in extra if n.lower() not in listed])


@dataclass(frozen=True)
class Layout:
    """How a table's rows are parted: by buckets of its keys, or by columns of its own."""

    buckets: int = 0
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @staticmethod
    def of(schema: T.StructType, buckets: int, keys: Sequence[str], partition_by: Sequence[str]) -> "Layout":
        """Checked against a table's schema, names in its case."""
        names = {f.name.lower(): f for f in schema.fields}
        if buckets and partition_by:
            raise ValueError("a table is laid out by buckets or by columns, not by both")
        if buckets and not keys:
            raise ValueError("buckets need the key columns")
        absent = [c for c in (*(keys if buckets else ()), *partition_by) if c.lower() not in names]
        if absent:
            raise ValueError(f"layout columns {absent} are not in the table")
        for column in partition_by:
            kind = names[column.lower()].dataType
            if not isinstance(kind, (T.StringType, T.IntegralType, T.DateType, T.BooleanType)):
                raise ValueError(f"a table cannot be partitioned by {column} of type {kind.simpleString()}")
            if names[column.lower()].name in HISTORY_COLUMNS:
                raise ValueError(f"{column} is kept by the table itself")
        return Layout(
            int(buckets), tuple(names[k.lower()].name for k in keys) if buckets else (),
            tuple(names[c.lower()].name for c in partition_by),
        )

    @property
    def columns(self) -> tuple[str, ...]:
        """The partition columns below the month."""
        return (_BUCKET,) if self.buckets else self.partition_by

    def bucket(self, schema: T.StructType, source: Mapping[str, str] | None = None) -> Column:
        """The bucket of a row, NULL if a key is; ``source`` names the columns that hold the keys."""
        values, known = [], F.lit(True)
        for key in self.keys:
            kind = schema[key].dataType
            value = F.col(_quoted((source or {}).get(key, key))).cast(kind)
            if isinstance(kind, (T.FloatType, T.DoubleType)):
                value = value + F.lit(0).cast(kind)  # -0.0 equals 0.0 and must hash like it
            values.append(value)
            known = known & value.isNotNull()
        return F.when(known, F.pmod(F.xxhash64(*values), F.lit(self.buckets))).cast("int")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class HistoryTable:
    """One history table below ``root``; a layout is chosen when it is created."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType | None = None,
        buckets: int = 0, keys: Sequence[str] = (), partition_by: Sequence[str] = (),
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self._given = schema
        self._wanted = (buckets, keys, partition_by)

    # -- pointer ---------------------------------------------------------
    @property
    def _pointers(self) -> str:
        return f"{self.root}/_pointer"

    def _pointer(self) -> dict | None:
        names = [n for n in folders.children(self.spark, self._pointers) if n.endswith(".json")]
        for name in reversed(names):
            try:
                pointer = json.loads(folders.read_text(self.spark, f"{self._pointers}/{name}"))
            except json.JSONDecodeError:
                continue  # a writer stopped while creating it: the one before counts
            # The number stays taken either way.
            return {**pointer, "version": int(names[-1].split(".")[0])}
        return None

    def _publish(self, pointer: dict) -> None:
        name = f"{self._pointers}/{pointer['version']:012d}.json"
        folders.create_text(self.spark, name, json.dumps(pointer, indent=1))

    # -- reading ---------------------------------------------------------
    def exists(self) -> bool:
        return self._pointer() is not None

    def create(self) -> "HistoryTable":
        """Make the empty table; does nothing when it exists."""
        if not self.exists():
            if self._given is None:
                raise ValueError("creating a history table needs a schema")
            absent = [c for c in HISTORY_COLUMNS if c not in self._given.names]
            if absent:
                raise ValueError(f"the schema lacks the history columns {absent}")
            layout = Layout.of(self._given, *self._wanted)
            self._publish({
                "version": 0, "schema": self._given.jsonValue(), "active": [], "closed": {}, "layout": asdict(layout),
            })
        return self

    def _require(self) -> dict:
        pointer = self._pointer()
        if pointer is None:
            raise ValueError(f"no history table at {self.root}: call create() first")
        return pointer

    @property
    def version(self) -> int:
        return self._require()["version"]

    def published(self, key: str) -> dict | None:
        """The progress note stored under ``key`` by the write that made it true; None if there is none."""
        return self._require().get("progress", {}).get(key)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._require()["schema"])

    @property
    def layout(self) -> Layout:
        return _layout(self._require())

    def _load(self, pointer: dict, paths: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(pointer["schema"])
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType(
            [f for f in schema.fields if f.name != ACTIVE]
            + [T.StructField(_LOAD, T.StringType()), T.StructField(ACTIVE, T.BooleanType()),
               T.StructField(_MONTH, T.StringType())]
            + ([T.StructField(_BUCKET, T.IntegerType())] if _layout(pointer).buckets else [])
        )
        frame = self.spark.read.schema(stored).option("basePath", self.root).parquet(*paths)
        return frame.select(*schema.names)

    def _load_active(self, pointer: dict) -> DataFrame:
        return self._load(pointer, [f"{self.root}/{folder}" for folder in pointer["active"]])

    def _load_closed(self, pointer: dict) -> DataFrame:
        by_start: dict[str, list[str]] = {}
        for folder, entry in pointer["closed"].items():
            paths = [f"{self.root}/{folder}/{_MONTH}={month}" for month in entry["months"]]
            by_start.setdefault(entry["from"] or "", []).extend(paths)
        result = self._load(pointer, by_start.pop("", []))
        for start, paths in by_start.items():
            kept = F.col(END).isNull() | (F.col(END) >= F.lit(start).cast("date"))
            result = result.unionByName(self._load(pointer, paths).filter(kept))
        return result

    def read(self) -> DataFrame:
        """All versions."""
        pointer = self._require()
        return self._load_active(pointer).unionByName(self._load_closed(pointer))

    def active(self) -> DataFrame:
        """Active versions only; closed folders are not listed, let alone read."""
        return self._load_active(self._require())

    def closed(self) -> DataFrame:
        """Closed versions only."""
        return self._load_closed(self._require())

    # -- touched partitions ----------------------------------------------
    def _parted(self, pointer: dict, batch: DataFrame, keys: Sequence[str]) -> tuple[list[str], list[str]]:
        """The active folders a batch touches, and the others."""
        layout, folders_ = _layout(pointer), list(pointer["active"])
        if not layout.columns or not folders_:
            return folders_, []
        depth = len(layout.columns)
        name_of = {folder: "/".join(folder.split("/")[-depth:]) for folder in folders_}
        schema = T.StructType.fromJson(pointer["schema"])
        given = {c.lower(): c for c in batch.columns}
        if layout.buckets:
            if {k.lower() for k in keys} != {k.lower() for k in layout.keys}:
                raise ValueError(f"the table's buckets are of the keys {list(layout.keys)}, not {list(keys)}")
            source = {k: given[k.lower()] for k in layout.keys}
            found = _few(batch.select(layout.bucket(schema, source).alias(_BUCKET)).where(F.col(_BUCKET).isNotNull()))
            touched = {f"{_BUCKET}={row[0]}" for row in found}
        else:
            values = [
                F.col(_quoted(given[c.lower()])).cast(schema[c].dataType).cast("string") if c.lower() in given else F.lit(None)
                for c in layout.partition_by
            ]
            named = _few(batch.select(*[v.cast("string").alias(c) for v, c in zip(values, layout.partition_by)]))
            touched = {"/".join(self._folder(c, v) for c, v in zip(layout.partition_by, row)) for row in named}
            if not {c.lower() for c in layout.partition_by} <= {k.lower() for k in keys}:
                touched |= self._partitions_of(pointer, batch, keys, depth)
        read = [folder for folder in folders_ if name_of[folder] in touched]
        return read, [folder for folder in folders_ if name_of[folder] not in touched]

    def _folder(self, column: str, value: str | None) -> str:
        """A partition's folder, as Spark names it."""
        names = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return names.getPartitionPathString(column, value)

    def _partitions_of(self, pointer: dict, batch: DataFrame, keys: Sequence[str], depth: int) -> set[str]:
        """Partitions in which keys of the batch lie: a scan of the key columns alone."""
        schema = T.StructType.fromJson(pointer["schema"])
        given = {c.lower(): c for c in batch.columns}
        names = {n.lower(): n for n in schema.names}
        keys = [names[k.lower()] for k in keys]
        sought = batch.select(*[F.col(_quoted(given[k.lower()])).cast(schema[k].dataType).alias(k) for k in keys])
        held = self._load_folders(pointer, pointer["active"]).select(*keys, "_folder")
        found = _few(held.join(sought, keys, "left_semi").select("_folder"))
        return {"/".join(row[0].rstrip("/").split("/")[-depth:]) for row in found}

    def _load_folders(self, pointer: dict, folders_: Sequence[str]) -> DataFrame:
        """Active rows of some folders with the folder they lie in."""
        schema = T.StructType.fromJson(pointer["schema"])
        fields = [f for f in schema.fields if f.name != ACTIVE] + [T.StructField(_MONTH, T.StringType())]
        reader = self.spark.read.schema(T.StructType(fields)).option("basePath", self.root)
        frame = reader.parquet(*[f"{self.root}/{folder}" for folder in folders_])
        return frame.withColumn("_folder", F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))

    # -- writing ---------------------------------------------------------
    def _write(self, rows: DataFrame, version: int, many_months: bool = False, layout: Layout = Layout()) -> str:
        """Write a load's rows to a folder of its own, whoever else is writing; returns its name."""
        rows = rows.withColumn(ACTIVE, F.coalesce(F.col(ACTIVE), F.lit(False)))
        rows = rows.withColumn(_MONTH, F.when(~F.col(ACTIVE), F.date_format(END, "yyyy-MM")))
        if layout.buckets:  # closed versions are not looked up, so they need no buckets
            rows = rows.withColumn(_BUCKET, F.when(F.col(ACTIVE), layout.bucket(rows.schema)))
        if many_months or layout.columns:
            # Few files per month and partition, large ones split: adaptive execution sees to both.
            rows = rows.hint("rebalance", ACTIVE, _MONTH, *layout.columns)
        # A few folders per task: written side by side, not sorted by folder first.
        setting = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(setting, None)
        self.spark.conf.set(setting, _OPEN_FILES)
        base = f"{_LOAD}={version}-{uuid.uuid4().hex[:8]}"
        try:
            rows.write.partitionBy(ACTIVE, _MONTH, *layout.columns).parquet(f"{self.root}/{base}")
        finally:
            if before is None:
                self.spark.conf.unset(setting)
            else:
                self.spark.conf.set(setting, before)
        return base

    def _leaves(self, folder: str, depth: int) -> list[str]:
        """Partition folders ``depth`` levels below a folder of the table."""
        if not depth:
            return [folder]
        names = [n for n in folders.children(self.spark, f"{self.root}/{folder}") if "=" in n]
        return [leaf for name in names for leaf in self._leaves(f"{folder}/{name}", depth - 1)]

    def _advance(self, pointer: dict, version: int, base: str, kept: Sequence[str] = ()) -> dict:
        depth = len(_layout(pointer).columns)
        written = folders.children(self.spark, f"{self.root}/{base}")
        closed = dict(pointer["closed"])
        closed_folder = f"{base}/{ACTIVE}=false"
        if f"{ACTIVE}=false" in written:
            names = folders.children(self.spark, f"{self.root}/{closed_folder}")
            months = [n.split("=", 1)[1] for n in names if n.startswith(f"{_MONTH}=")]
            closed[closed_folder] = {"months": months, "from": None}
        active = list(kept)
        if f"{ACTIVE}=true" in written:
            active += self._leaves(f"{base}/{ACTIVE}=true", depth + 1 if depth else 0)
        return {**pointer, "version": version, "active": active, "closed": closed}

    def _store(
        self, rows: DataFrame, kept: Sequence[str] | None, keep_closed: bool, progress: dict | None = None
    ) -> None:
        """Publish rows beside the active folders ``kept`` (None: all of them)."""
        pointer = _with_progress(self._require(), progress)
        version = pointer["version"] + 1
        schema = T.StructType.fromJson(pointer["schema"])
        named = _unparted(rows.select(*schema.names), _layout(pointer))
        base = self._write(named, version, many_months=not keep_closed, layout=_layout(pointer))
        if not keep_closed:
            pointer = {**pointer, "closed": {}}
        self._publish(self._advance(pointer, version, base, pointer["active"] if kept is None else kept))

    # ``progress`` holds notes, one for each key, that become visible together with the rows: how far
    # a source has been loaded. Whoever repeats a load after a crash finds them here.
    def replace(self, rows: DataFrame, progress: dict | None = None) -> None:
        """All versions anew, e.g. a first load from an existing table."""
        self._store(rows, kept=[], keep_closed=False, progress=progress)

    def replace_active(self, rows: DataFrame, progress: dict | None = None, kept: Sequence[str] = ()) -> None:
        """Active versions anew, but for the folders ``kept``; closed ones stay."""
        self._store(rows, kept=list(kept), keep_closed=True, progress=progress)

    def touched(self, batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """Active versions of the partitions a batch touches, and the active folders it does not touch.

        Without a layout every active version is touched. Nothing else of the table can match a key of the batch.
        """
        pointer = self._require()
        read, kept = self._parted(pointer, batch, keys)
        return self._load(pointer, [f"{self.root}/{folder}" for folder in read]), kept

    def append(self, rows: DataFrame, progress: dict | None = None) -> None:
        """Add versions; nothing stored is rewritten."""
        self._store(rows, kept=None, keep_closed=True, progress=progress)

    def merge(
        self, batch: DataFrame, keys: Sequence[str], run_ts=None, progress: dict | None = None, **options
    ) -> MergeCounts:
        """Merge a batch of current rows; one write job also yields the counts.

        Of a table with a layout only touched partitions are read and rewritten, and the versions counted as
        unchanged are those of touched partitions.
        """
        pointer = _with_progress(self._require(), progress)
        version = pointer["version"] + 1
        layout = _layout(pointer)
        batch = _unparted(batch, layout)
        read, kept = self._parted(pointer, batch, keys)
        active = self._load(pointer, [f"{self.root}/{folder}" for folder in read])
        merged = merge_active(active, batch, keys, run_ts, **options)
        seen = Observation(f"merge-{version}")
        merged = merged.observe(seen, *[count_outcome(name) for name in (EXPIRED, INSERTED, KEPT)])
        base = self._write(merged.drop(OUTCOME), version, layout=layout)
        counts = seen.get
        self._publish(self._advance(pointer, version, base, kept))
        return MergeCounts(counts[EXPIRED], counts[INSERTED], counts[KEPT])

    def purge(self, days: int, run_ts=None) -> list[str]:
        """Forget closed versions that ended more than ``days`` days before the run's date.

        Returns the folders let go or cut short. :meth:`vacuum` deletes files later.
        """
        cutoff = (_as_date(run_ts) - timedelta(days=int(days))).isoformat()
        pointer = self._require()
        kept, changed = {}, []
        for folder, entry in pointer["closed"].items():
            months = [m for m in entry["months"] if m == _NO_MONTH or m >= cutoff[:7]]
            changed += [f"{folder}/{_MONTH}={m}" for m in entry["months"] if m not in months]
            start = entry["from"]
            if cutoff[:7] in months and not cutoff.endswith("-01") and (start or "") < cutoff:
                start = cutoff
                changed.append(f"{folder}/{_MONTH}={cutoff[:7]}")
            if months:
                kept[folder] = {"months": months, "from": start}
        if changed:
            self._publish({**pointer, "version": pointer["version"] + 1, "closed": kept})
        return changed

    def vacuum(self, keep_versions: int = 1) -> list[str]:
        """Delete folders the newest ``keep_versions`` pointers do not refer to."""
        names = [n for n in folders.children(self.spark, self._pointers) if n.endswith(".json")]
        alive: set[str] = set()
        kept = 0
        for name in reversed(names):
            if kept >= max(keep_versions, 1):
                break
            try:
                pointer = json.loads(folders.read_text(self.spark, f"{self._pointers}/{name}"))
            except json.JSONDecodeError:
                continue
            kept += 1
            alive.update(pointer["active"])
            alive.update(f"{f}/{_MONTH}={m}" for f, entry in pointer["closed"].items() for m in entry["months"])
        newest = int(names[-1].split(".")[0]) if names else 0
        removed = []
        for load in folders.children(self.spark, self.root):
            # Higher numbers belong to loads that have not published yet.
            if not load.startswith(f"{_LOAD}=") or int(load.split("=")[1].split("-")[0]) > newest:
                continue
            for part in folders.children(self.spark, f"{self.root}/{load}"):
                if part == f"{ACTIVE}=true":
                    depth = len(self.layout.columns)
                    candidates = self._leaves(f"{load}/{part}", depth + 1 if depth else 0)
                elif part == f"{ACTIVE}=false":
                    months = folders.children(self.spark, f"{self.root}/{load}/{part}")
                    candidates = [f"{load}/{part}/{m}" for m in months if m.startswith(f"{_MONTH}=")]
                else:
                    continue
                removed += [c for c in candidates if c not in alive]
        for path in removed:
            folders.remove(self.spark, f"{self.root}/{path}")
        return removed


def _layout(pointer: dict) -> Layout:
    found = pointer.get("layout") or {}
    return Layout(found.get("buckets", 0), tuple(found.get("keys", ())), tuple(found.get("partition_by", ())))


def _unparted(rows: DataFrame, layout: Layout) -> DataFrame:
    """Empty strings in partition columns as NULL, which is how a partition's folder gives them back."""
    for column in layout.partition_by:
        present = next((c for c in rows.columns if c.lower() == column.lower()), None)
        if present and isinstance(rows.schema[present].dataType, T.StringType):
            rows = rows.withColumn(present, F.nullif(F.col(_quoted(present)), F.lit("")))
    return rows


def _few(names: DataFrame) -> list:
    """Distinct names of partitions; a load that touches too many stops."""
    found = names.distinct().limit(MOST_PARTITIONS + 1).collect()
    if len(found) > MOST_PARTITIONS:
        raise ValueError(f"a load touches more than {MOST_PARTITIONS} partitions: choose a coarser layout")
    return found


def _with_progress(pointer: dict, progress: dict | None) -> dict:
    return {**pointer, "progress": {**pointer.get("progress", {}), **(progress or {})}}


def _as_date(run_ts) -> date:
    if run_ts is None:
        return date.today()
    if isinstance(run_ts, datetime):
        return run_ts.date()
    if isinstance(run_ts, date):
        return run_ts
    return date.fromisoformat(str(run_ts)[:10])
