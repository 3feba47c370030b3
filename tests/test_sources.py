from __future__ import annotations

import gzip
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from millrace.catalogue import EntityRegistry, FileFormat, load_catalogue, load_properties, lookup, read_properties_frame
from millrace.sources import (
    RawEntity,
    append_log,
    empty_like,
    file_list,
    files_to_process,
    headers_by_file,
    incremental_read,
    log_path,
    read_delimited,
    read_delta,
    read_files,
    read_jdbc,
    read_log,
    read_many,
    read_multiline,
    read_repaired,
    read_whole_text,
    type_log,
)
from millrace.sources.incremental import read_entity_files
from millrace.sources.multiline import _line_patterns, splits
from showcase import files
from showcase.registry import QUERIES
from tests.conftest import rows


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


# -- delimited -------------------------------------------------------------
def test_delimited_options(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id||txt\n1||"two\nlines"\n2||"a \\"quote\\""\n')
    df = read_delimited(spark, path, FileFormat(delimiter="||"))
    assert df.columns == ["id", "txt", "file_name", "file_modification_time"]
    assert rows(df.select("id", "txt", "file_name")) == [("1", "two\nlines", "a.csv"), ("2", 'a "quote"', "a.csv")]
    assert dict(df.dtypes)["id"] == "string"


def test_bad_rows_fail_fast_or_pass(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,txt\n1,a\n2\n")
    with pytest.raises(Exception):
        read_delimited(spark, path).collect()
    assert read_delimited(spark, path, FileFormat(fail_fast=False)).count() == 2


def test_columns_without_header(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,a\n")
    df = read_delimited(spark, path, FileFormat(header=False), columns=["x", "y"], lineage=False)
    assert rows(df) == [("1", "a")] and df.columns == ["x", "y"]


def test_glob_and_path_filter(spark, tmp_path):
    for year in (2023, 2024):
        write(tmp_path / str(year) / f"t_{year}.csv", f"id\n{year}\n")
        write(tmp_path / str(year) / "other.txt", "id\n0\n")
    assert rows(read_delimited(spark, f"{tmp_path}/*/t_*.csv").select("id")) == [("2023",), ("2024",)]
    assert rows(read_delimited(spark, str(tmp_path), path_filter="t_2024*").select("id")) == [("2024",)]


def test_many_files_by_position_and_by_name(spark, tmp_path):
    one = write(tmp_path / "1.csv", "a,b\n1,x\n")
    two = write(tmp_path / "2.csv", "b,a,c\ny,2,z\n")
    three = write(tmp_path / "3.csv", "a,b\n3,w\n")
    assert headers_by_file(spark, [one, two, three]).count() == 2
    by_name = read_many(spark, [one, two, three], by_name=True, lineage=False)
    assert rows(by_name.select("a", "b", "c")) == [("1", "x", None), ("2", "y", "z"), ("3", "w", None)]
    assert rows(read_many(spark, [one, three], lineage=False)) == [("1", "x"), ("3", "w")]
    with pytest.raises(ValueError, match="no files"):
        read_many(spark, [])


@pytest.mark.parametrize("seed", range(3))
def test_multiline_across_blocks_equals_the_plain_reader(spark, tmp_path, seed):
    rng = random.Random(seed)
    pieces = ["a", "b,", '"', "\n", "\r\n", "", " ", "\\", "é", "||", "#", "\n\n", "long text " * 3]
    data = [
        (i, *["".join(rng.choice(pieces) for _ in range(rng.randint(0, 5))) or None for _ in range(3)])
        for i in range(80)
    ]
    df = spark.createDataFrame(data, "id int, a string, b string, c string")
    escape = "\\" if seed else '"'
    fmt = FileFormat(delimiter="||" if seed == 2 else ",", escape=escape)
    df.repartition(3).write.option("header", True).option("sep", fmt.delimiter).option("escape", escape).csv(f"{tmp_path}/in")
    want = rows(read_delimited(spark, f"{tmp_path}/in", fmt).drop("file_modification_time"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    try:
        got = rows(read_multiline(spark, f"{tmp_path}/in", fmt).drop("file_modification_time"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(want) == 80 and got == want


def test_multiline_without_header_and_with_crlf(spark, tmp_path):
    path = write(tmp_path / "a.csv", '1,"x\r\ny"\r\n\r\n2,z\r\n')
    df = read_multiline(spark, path, FileFormat(header=False), columns=["id", "t"], lineage=False)
    assert rows(df) == [("1", "x\r\ny"), ("2", "z")]
    bad = write(tmp_path / "b.csv", "id,t\n1,x\n2\n")
    with pytest.raises(Exception):
        read_multiline(spark, bad).collect()


# -- other sources ---------------------------------------------------------
def test_formats(spark, tmp_path):
    spark.range(3).write.json(f"{tmp_path}/j")
    assert read_files(spark, f"{tmp_path}/j", ".json", lineage=True).count() == 3
    write(tmp_path / "c.csv", "id\n1\n")
    assert read_files(spark, f"{tmp_path}/c.csv", FileFormat(extension=".csv")).first() == ("1",)
    assert rows(read_whole_text(spark, f"{tmp_path}/c.csv").select("text")) == [("id\n1\n",)]
    assert empty_like(spark, "a int, b string").dtypes == [("a", "int"), ("b", "string")]


def test_absent_sources_say_so(spark, tmp_path):
    with pytest.raises(RuntimeError, match="Delta"):
        read_delta(spark, str(tmp_path))
    with pytest.raises(ValueError, match="parallel read"):
        read_jdbc(spark, "jdbc:none:x", "t", partition_column="id")


def test_properties_and_registry(spark, tmp_path):
    document = (
        '{"System": {"EntityName": "T", "FileFormat": {"Extension": ".csv", "ColumnDelimiter": ";", "Header": "True",'
        ' "MultiLine": "false"}},\n "Catalogue": {"Schema": {"NaturalKey": ["Id"],'
        ' "Attributes": [{"Name": "Id", "Type": "int"}]}}}'
    )
    path = write(tmp_path / "t.properties", document)
    assert load_catalogue(path, spark).natural_key == ("Id",)
    fmt = FileFormat.from_document(load_properties(path, spark))
    assert fmt == FileFormat(delimiter=";", multiline=False) and fmt.read_format == "csv"
    assert lookup(load_properties(path, spark), "system.entityname") == "T"
    with pytest.raises(ValueError, match="FileFormat"):
        FileFormat.from_document({})
    table = spark.createDataFrame([("raw.T", "raw/t")], "EntityFullyQualifiedName string, EntityPath string")
    registry = EntityRegistry.from_frame(table)
    assert registry.find("RAW.t")["EntityPath"] == "raw/t"
    with pytest.raises(KeyError):
        registry.find("raw.U")


# -- processing log --------------------------------------------------------
def test_properties_frame_infers_from_all_documents_by_tasks(spark, tmp_path):
    folder = tmp_path / "properties"
    folder.mkdir()
    (folder / "a.json").write_text('{\n "System": {"Name": "a", "Days": 3}\n}')
    (folder / "b.json").write_text('[{"System": {"Name": "b", "Extra": {"x": "y"}}}, {"System": {"Days": 1.5}}]')
    (folder / "c.json").write_bytes('{"System": {"Name": "ç"}}'.encode("utf-16"))
    (folder / "d.json.gz").write_bytes(gzip.compress(b'\xef\xbb\xbf{"System": {"Name": "d"}}'))
    (folder / "e.json").write_text("")
    found = read_properties_frame(spark, str(folder), {"name": "System.Name", "days": "System.Days", "x": "System.Extra.x"})
    plain = spark.read.option("multiLine", True).json(str(folder)).select("System.Name", "System.Days", "System.Extra.x")
    assert found.toDF(*plain.columns).schema == plain.schema
    assert rows(found) == rows(plain)
    assert [r[0] for r in rows(found) if r[0]] == ["a", "b", "d", "ç"]


@pytest.mark.parametrize("name, source, columns", [
    ("whole_file_text", "pages", ["id AS page_id", "'h' || id AS html"]),
    ("nested_config_fields", "supplier", ["'s' || id AS s_name", "id AS s_nationkey"]),
])
def test_a_file_per_row_is_written_by_many_tasks(spark, tmp_path, monkeypatch, name, source, columns):
    spark.range(0, 40, 1, 1).selectExpr(*columns).write.parquet(f"{tmp_path}/{source}.parquet")
    monkeypatch.setattr(files, "work_path", lambda spark, label: f"{tmp_path}/work")
    assert QUERIES[name](spark, str(tmp_path)).count() == 40
    written = [p.name for p in (tmp_path / "work").glob("part-*")]
    assert len(written) == 40
    assert len({n.split("-")[1] for n in written}) >= 4


def test_files_to_process(spark, tmp_path):
    path = log_path(str(tmp_path), "T")
    assert path.endswith("/T.meta")
    log = spark.createDataFrame([
        ("2024/01", 5, "a.csv", "2024-01-01 00:00:00.123456"), ("2024/02", 0, "b.csv", "2024-02-01 00:00:00"),
        ("2024/03", -1, "c.csv", "2024-03-01 00:00:00"), ("2024/04", 7, "d.csv", "2024-04-01 00:00:00"),
    ], "FilePath string, NumberOfRows int, FileName string, ProcessedDateTime string")
    append_log(log, path)
    back = read_log(spark, path)
    assert back.selectExpr("max(NumberOfRows)", "cast(min(ProcessedDateTime) as string)").first() == (7, "2024-01-01 00:00:00.123456")
    assert file_list(files_to_process(back, "raw")) == ["raw/2024/01/a.csv", "raw/2024/04/d.csv"]
    assert file_list(files_to_process(back, "raw", "2024-01-01 00:00:00.123456")) == ["raw/2024/04/d.csv"]
    assert file_list(files_to_process(back, "raw", upper="2024-01-01 00:00:00.123456")) == ["raw/2024/01/a.csv"]
    raw = spark.createDataFrame([("p", "many", "f", "never")], "FilePath string, NumberOfRows string, FileName string, ProcessedDateTime string")
    assert type_log(raw).first() == ("p", None, "f", None)


# -- incremental -----------------------------------------------------------
def test_incremental_by_file_time_skips_old_files_unopened(spark, tmp_path):
    write(tmp_path / "raw" / "old.csv", "id\n1\n2,corrupt\n")
    seen = read_delimited(spark, f"{tmp_path}/raw/old.csv", FileFormat(fail_fast=False), columns=["id"])
    mark = seen.selectExpr("cast(max(file_modification_time) as string)").first()[0]
    time.sleep(0.05)
    write(tmp_path / "raw" / "new.csv", "id\n3\n")
    entity = RawEntity(f"{tmp_path}/raw", "T")
    assert rows(incremental_read(spark, entity, mark, "/*.csv").select("id")) == [("3",)]
    with pytest.raises(Exception):
        incremental_read(spark, entity, None, "/*.csv").collect()


def test_incremental_by_log_forwards_the_bounds(spark, tmp_path):
    for day in ("01", "02", "03"):
        write(tmp_path / "T" / day / "f.csv", f"id\n{day}\n")
    entity = RawEntity(f"{tmp_path}/T", "T")
    append_log(spark.createDataFrame(
        [(d, 1, "f.csv", f"2024-01-{d} 00:00:00") for d in ("01", "02", "03")],
        "FilePath string, NumberOfRows int, FileName string, ProcessedDateTime string"), entity.log_folder)
    found = incremental_read(spark, entity, "2024-01-01 00:00:00", extra_columns=["MemberType"], upper="2024-01-02 00:00:00")
    assert rows(found.select("id", "MemberType")) == [("02", "Standard")]
    assert incremental_read(spark, entity).count() == 3
    assert incremental_read(spark, entity, "2024-01-03 00:00:00") is None


# -- repair ----------------------------------------------------------------
def by_hand(text, delimiter):
    """One record at a time: the first CR after the last delimiter ends it."""
    header, _, rest = text.partition("\r")
    width = len(header.split(delimiter))
    found = []
    while True:
        at = 0
        for _ in range(width - 1):
            at = rest.find(delimiter, at)
            if at < 0:
                return found
            at += len(delimiter)
        end = rest.find("\r", at)
        end = len(rest) if end < 0 else end
        record = rest[:end].removeprefix("\n").split(delimiter)
        found.append(tuple(f[1:-1] if len(f) > 1 and f[0] == f[-1] == '"' else f for f in record))
        rest = rest[end + 1:]


def malformed(rng, records, columns=3, ascii_only=False):
    pieces = ["a", "b ", 'he said "hi"', "\n", "\r\n", "", ",", "|", "*", "'", "\\", "0"]
    pieces += [] if ascii_only else ["é", "☃", "§", "😀"]
    lines = ["|*".join(f"c{i}" for i in range(columns))]
    for _ in range(records):
        fields = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(columns)]
        fields = [f.replace("|*", "|") for f in fields]
        fields[-1] = fields[-1].replace("\r", "")
        lines.append("|*".join(f'"{f}"' for f in fields))
    return "\r\n".join(lines) + rng.choice(["\r\n", ""])


@pytest.mark.parametrize("seed", range(4))
def test_repair_equals_reading_by_hand_across_blocks(spark, tmp_path, seed):
    rng = random.Random(seed)
    columns = rng.choice([2, 3, 5])
    texts = {f"f{i}.dat": malformed(rng, n, columns) for i, n in enumerate((0, 1, 60, 25))}
    for name, text in texts.items():
        write(tmp_path / "in" / name, text, "utf-16le")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = read_repaired(spark, f"{tmp_path}/in", "|*")
        assert df.columns == [*[f"c{i}" for i in range(columns)], "file_name", "file_modification_time"]
        got = rows(df.drop("file_modification_time"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = sorted(((*r, name) for name, text in texts.items() for r in by_hand(text, "|*")), key=repr)
    assert len(want) == 86 and got == want


def test_repair_of_nul_interleaved_bytes(spark, tmp_path):
    text = malformed(random.Random(3), 20, ascii_only=True)
    write(tmp_path / "a.dat", "".join(ch + "\0" for ch in text))
    got = rows(read_repaired(spark, f"{tmp_path}/a.dat", encoding="UTF-8").select("c0", "c1", "c2"))
    assert got == sorted(by_hand(text, "|*"), key=repr)


def test_repair_example_and_byte_order_mark(spark, tmp_path):
    text = '﻿a|*b|*c\r\n"1"|*"he said "hi""|*"x"\r\n"2"|*"line1\nline2"|*"y"\r\n'
    write(tmp_path / "a.dat", text, "utf-16le")
    df = read_repaired(spark, f"{tmp_path}/a.dat")
    assert rows(df.select("a", "b", "c")) == [("1", 'he said "hi"', "x"), ("2", "line1\nline2", "y")]


def test_repair_modes_for_incomplete_records(spark, tmp_path):
    write(tmp_path / "a.dat", 'a|*b|*c\r\n"1"|*"x"|*"y"\r\n"2"|*"cut', "utf-16le")
    path = f"{tmp_path}/a.dat"
    with pytest.raises(Exception, match="incomplete record"):
        read_repaired(spark, path).collect()
    assert read_repaired(spark, path, mode="DROPMALFORMED").count() == 1
    kept = read_repaired(spark, path, mode="PERMISSIVE").select("a", "c")
    assert rows(kept) == [("1", "y"), ("2", None)]
    with pytest.raises(ValueError):
        read_repaired(spark, path, mode="GUESS")


def test_repair_refuses_other_headers_and_single_columns(spark, tmp_path):
    write(tmp_path / "in" / "a.dat", 'a|*b\r\n"1"|*"x"\r\n', "utf-16le")
    write(tmp_path / "in" / "b.dat", 'a|*z\r\n"1"|*"x"\r\n', "utf-16le")
    with pytest.raises(Exception, match="another header"):
        read_repaired(spark, f"{tmp_path}/in", columns=["a", "b"]).collect()
    write(tmp_path / "one.dat", 'a\r\n"1"\r\n', "utf-16le")
    with pytest.raises(ValueError, match="two columns"):
        read_repaired(spark, f"{tmp_path}/one.dat")


def test_repair_refuses_carriage_return_bytes_across_characters(spark, tmp_path):
    # U+0D05 U+0100 hold the bytes 05 0D 00 01: a CR where no character is one.
    write(tmp_path / "a.dat", 'a|*b\r\n"അĀ"|*"x"\r\n', "utf-16le")
    with pytest.raises(Exception, match="inside a character pair"):
        read_repaired(spark, f"{tmp_path}/a.dat", columns=["a", "b"]).collect()


def test_entity_format_chooses_the_split_reader(spark, tmp_path):
    write(tmp_path / "T" / "a.csv", 'id,t\n1,"x\ny"\n')
    fmt = FileFormat.from_document({"System": {"FileFormat": {"SplitMultiLine": "true"}}})
    found = incremental_read(spark, RawEntity(f"{tmp_path}/T", "T", fmt), path_filter="/*.csv")
    assert rows(found.select("id", "t", "file_name")) == [("1", "x\ny", "a.csv")]


def test_entity_format_chooses_the_repair(spark, tmp_path):
    write(tmp_path / "T" / "a.dat", 'a|*b\r\n"1"|*"x"\r\n', "utf-16le")
    entity = RawEntity(f"{tmp_path}/T", "T", FileFormat(extension=".dat", delimiter="|*", nul_interleaved=True))
    assert rows(incremental_read(spark, entity, path_filter="/*.dat").select("a", "b")) == [("1", "x")]
    later = incremental_read(spark, entity, "2999-01-01 00:00:00", "/*.dat")
    assert later.filter(F.col("a").isNotNull()).count() == 0


def test_encoding_and_mode_come_from_the_document(spark, tmp_path):
    layout = {"Extension": ".dat", "ColumnDelimiter": "|*", "StripEvenCharactersFromRawFile": "true", "Encoding": "UTF-8", "FailFast": "false"}
    text = 'a|*b|*c\r\n"1"|*"x"|*"y"\r\n"2"|*"cut'
    write(tmp_path / "T" / "a.dat", "".join(ch + "\0" for ch in text))
    entity = RawEntity(f"{tmp_path}/T", "T", FileFormat.from_document({"System": {"FileFormat": layout}}))
    assert rows(incremental_read(spark, entity, path_filter="/*.dat").select("a", "c")) == [("1", "y"), ("2", None)]
    strict = RawEntity(entity.path, "T", FileFormat.from_document({"System": {"FileFormat": {**layout, "FailFast": "true"}}}))
    with pytest.raises(Exception, match="incomplete record"):
        incremental_read(spark, strict, path_filter="/*.dat").collect()
    write(tmp_path / "L" / "a.csv", "id,t\n1,é\n", "latin-1")
    for split in (False, True):
        latin = RawEntity(f"{tmp_path}/L", "L", FileFormat(encoding="ISO-8859-1", split_multiline=split))
        assert rows(incremental_read(spark, latin, path_filter="/*.csv").select("id", "t")) == [("1", "é")]


# -- line breaks inside fields, any quotes -----------------------------------
def _odd_file(rng, escape, wild):
    if wild:
        return "".join(rng.choice(["a", '"', '"', "\\", ",", "\n", " ", "é"]) for _ in range(rng.randint(1, 12))) + "\n"

    def text(letters):
        return "".join(rng.choice(letters) for _ in range(rng.randint(1, 5)))

    kinds = [
        lambda: text("ab"), lambda: f'{text("ab")}"{text("ab")}{chr(34)}{text("ab")}', lambda: f'"{text(["a", ",", chr(10)])}"',
        lambda: f'"{text(["b", ",", chr(10)])}{escape}"{text(["b", ",", chr(10)])}"',
        lambda: f'"{text("ab")}"{text("ab ")}"{text("ab")}"', lambda: f'"a{text(["b", chr(10)])}{escape}{escape}"',
    ]
    lines = (",".join(rng.choice(kinds)() for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 5)))
    return "\n".join(lines) + "\n"


def _cut_off(text, fmt):
    """Whether a file ends inside a quoted field: such a field's end is no one's to say. Nor is a quote before an escape."""
    if fmt.escape != '"' and '"' + fmt.escape in text:
        return True
    outside, inside = (re.compile(p.replace("\\z", "\\Z")) for p in _line_patterns(fmt))
    open_ = False
    for line in text.split("\n"):
        line = line.removesuffix("\r")
        open_ = bool(inside.search(line) if open_ else outside.search(fmt.delimiter + line))
    return open_


@pytest.mark.parametrize("wild", [False, True])
@pytest.mark.parametrize("escape", ["\\", '"'])
@pytest.mark.parametrize("unescaped", ["STOP_AT_DELIMITER", "STOP_AT_CLOSING_QUOTE"])
def test_split_reader_equals_the_one_task_reader(spark, tmp_path, unescaped, escape, wild):
    rng = random.Random(f"{unescaped}{escape}{wild}")
    fmt = FileFormat(escape=escape, unescaped_quotes=unescaped, header=False, fail_fast=False)
    texts = {f"f{n}.csv": _odd_file(rng, escape, wild) for n in range(250)}
    texts = {name: text for name, text in texts.items() if not _cut_off(text, fmt)}
    for name, text in texts.items():
        write(tmp_path / name, text, "utf-8")
    columns = ["c0", "c1", "c2"]

    def by_file(df):
        found = {name: [] for name in texts}
        for r in df.collect():
            if any(r[:3]):
                found[r["file_name"]].append(tuple(r[:3]))
        return {name: sorted(part, key=repr) for name, part in found.items()}

    want = by_file(read_delimited(spark, str(tmp_path), fmt, columns=columns, enforceSchema="true"))
    got = by_file(read_multiline(spark, str(tmp_path), fmt, columns=columns))
    wrong = {texts[n]: (got[n], want[n]) for n in texts if got[n] != want[n]}
    assert len(texts) > 100 and not wrong


def test_split_reader_uses_many_tasks_of_one_file(spark, tmp_path):
    rng = random.Random(4)
    fields = [["plain", 'in"side', '"two\nlines, \\"quoted\\""', '"a\\\\"', '"odd"quote'][rng.randrange(5)] for _ in range(3000)]
    lines = [f"{i},{a}" for i, a in enumerate(fields)]
    write(tmp_path / "one.csv", "id,t\n" + "\n".join(lines) + "\n", "utf-8")
    fmt = FileFormat()
    want = rows(read_delimited(spark, str(tmp_path), fmt, lineage=False))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines_read = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        got = rows(read_multiline(spark, str(tmp_path), fmt, lineage=False))
        assert lines_read > 8 and got == want and len(got) == 3000
        # The format's default splits a file that is larger than what one task reads.
        entity = RawEntity(str(tmp_path), "one", fmt)
        assert splits(spark, str(tmp_path), fmt)
        assert rows(read_entity_files(spark, entity, str(tmp_path)).select("id", "t")) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert not splits(spark, str(tmp_path), fmt)
    with pytest.raises(ValueError, match="cannot be split"):
        read_multiline(spark, str(tmp_path), FileFormat(unescaped_quotes="BACK_TO_DELIMITER"))
