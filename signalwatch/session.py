"""The two things the library needs from the caller's session: a shared folder and stream settings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster a machine-local folder
    would not be visible to the executors, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_dir()


@cache
def _local_dir() -> str:
    """One temporary folder per process, for local sessions."""
    return tempfile.mkdtemp(prefix="signalwatch-")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return f"{shared_dir(spark)}/signalwatch/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


# Bytes of rows that a Python worker is handed at once: rows can be long texts.
BATCH_BYTES = "8m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would.

    Workers then get rows in batches of ``BATCH_BYTES``, unless the application has set another size.
    """
    if spark.sparkContext.applicationId in _shipped:
        return
    if not spark.sparkContext.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    _shipped.add(spark.sparkContext.applicationId)
    home = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(home)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, files in os.walk(home):
            for file in files:
                if file.endswith(".py"):
                    whole = os.path.join(folder, file)
                    packed.write(whole, os.path.join(name, os.path.relpath(whole, home)))
    spark.sparkContext.addPyFile(path)


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL settings for the duration of a block, then put the old values back."""
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
