"""Versioned folders for saved models.

A version's tables go to a new folder below ``<root>/versions``; a commit, a one-row table below
``<root>/commits`` whose name counts up, then names that folder.  Readers take the last complete
commit, so a save that fails in the middle leaves the model as it was, and a model can be saved over
the folder it was read from.  The versions of the last ``KEEP`` commits stay, because models loaded
from them are lazy and still read their tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from ..session import drop_table

KEEP = 3


def _children(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _commits(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete commits, in order."""
    return [c for c in _children(spark, f"{root}/commits") if "_SUCCESS" in _children(spark, f"{root}/commits/{c}")]


def _read(spark: SparkSession, root: str, commit: str) -> dict:
    return json.loads(spark.read.parquet(f"{root}/commits/{commit}").first()["about"])


def save(spark: SparkSession, path: str, write: Callable[[str], None], about: dict) -> str:
    """Let ``write`` fill a new version's folder, then commit it with ``about``; the folder."""
    root = path.rstrip("/")
    folder = f"{root}/versions/{uuid.uuid4().hex}"
    before = _children(spark, f"{root}/commits")
    try:
        write(folder)
        row = [(json.dumps({**about, "folder": folder.rsplit("/", 1)[1]}),)]
        number = int(before[-1]) + 1 if before else 1
        # an existing commit of that number is another writer's: an error, not overwritten
        spark.createDataFrame(row, "about string").coalesce(1).write.mode("error").parquet(f"{root}/commits/{number:010d}")
    except Exception:
        drop_table(spark, folder)
        raise
    done = _commits(spark, root)
    for old in done[:-KEEP]:
        drop_table(spark, f"{root}/versions/{_read(spark, root, old)['folder']}")
        drop_table(spark, f"{root}/commits/{old}")
    return folder


def load(spark: SparkSession, path: str) -> tuple[str, dict]:
    """Folder and ``about`` of the last complete version."""
    root = path.rstrip("/")
    done = _commits(spark, root)
    if not done:
        raise FileNotFoundError(f"no saved model in {root}")
    about = _read(spark, root, done[-1])
    return f"{root}/versions/{about['folder']}", about
