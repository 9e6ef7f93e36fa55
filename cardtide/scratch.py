"""Where jobs put tables and checkpoints that they make for themselves."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder;
    on a cluster a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="run-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/cardtide-{uuid.uuid4().hex}/{name}"
