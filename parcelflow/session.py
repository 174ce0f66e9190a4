"""Session settings the jobs rely on, and the folder tasks share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Message JSON may repeat a key; the last value counts instead of failing the message.
_REQUIRED = {"spark.sql.variant.allowDuplicateKeys": "true"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings message parsing depends on."""
    for name, value in _REQUIRED.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(app: str = "parcelflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session for tests, the benchmark and local runs; a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="parcelflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/parcelflow/{purpose}-{uuid.uuid4().hex}"
