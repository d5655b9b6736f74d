"""Where intermediate tables and stream checkpoints go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from smogline.sources.files import delete

SETTING = "spark.checkpoint.dir"
# The folder of the run that is going on, if there is one.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    folder = context.getConf().get(SETTING) or spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="smogline-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    place = _RUN.get() or f"{shared_folder(spark).rstrip('/')}/smogline"
    return f"{place}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def cleared(spark: SparkSession) -> Iterator[str]:
    """Remove the intermediate tables that are made inside when it ends.

    For work whose result is written inside, to a place of its own: what reads
    the tables must not be used afterwards. Runs may be nested.
    """
    folder = new_folder(spark, "run")
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        delete(spark, folder)
