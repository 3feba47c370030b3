"""Metadata-driven ingestion into cleansed history tables, as Spark DataFrame plans."""

from millrace.catalogue import Attribute, Catalogue, EntityRegistry, FileFormat, load_catalogue, load_properties
from millrace.operators import *  # noqa: F401,F403
from millrace.operators import __all__ as _operators
from millrace.plans import JobConfig, JobResult, run_job
from millrace.session import build_session
from millrace.sinks import HistoryTable, HwmState
from millrace.streaming import run_stream

__all__ = [
    *_operators, "Attribute", "Catalogue", "EntityRegistry", "FileFormat", "HistoryTable", "HwmState",
    "JobConfig", "JobResult", "build_session", "load_catalogue", "load_properties", "run_job", "run_stream",
]
