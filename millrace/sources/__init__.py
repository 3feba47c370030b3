"""Sources: files, tables and the processing log as DataFrames."""

from millrace.sources.delimited import headers_by_file, read_delimited, read_many, write_delimited
from millrace.sources.files import empty_like, read_delta, read_files, read_jdbc, read_whole_text
from millrace.sources.incremental import RawEntity, incremental_read, newer_than
from millrace.sources.multiline import read_multiline
from millrace.sources.processing_log import append_log, file_list, files_to_process, log_path, read_log, type_log
from millrace.sources.repair import read_repaired, read_segments

__all__ = [
    "RawEntity", "append_log", "empty_like", "file_list", "files_to_process", "headers_by_file",
    "incremental_read", "log_path", "newer_than", "read_delimited", "read_delta", "read_files",
    "read_jdbc", "read_log", "read_many", "read_multiline", "read_repaired", "read_segments", "read_whole_text",
    "type_log", "write_delimited",
]
