"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings the library relies on; everything else stays with the cluster.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_OWN_FOLDERS: dict[str, str] = {}


def build_session(app_name: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. ``master`` is for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SESSION_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset
    (plain local runs) a temporary folder is made, one for an application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="millrace-")
    return _OWN_FOLDERS[application]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
