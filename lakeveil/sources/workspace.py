"""Where jobs put intermediate tables: the folder the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_made: ContextVar[list[str] | None] = ContextVar("lakeveil_made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. A session inside one process may do without the
    setting and gets a folder of its own; on a cluster a missing setting is an error, as
    executors don't see each other's disks."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="lakeveil-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Folders that ``new_folder`` and ``stored`` make inside are removed at the end, also after an error. What shall
    outlast the block is written to a folder made before it; frames that read the removed ones must not be used on."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in made:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, cut off from its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: it is computed once,
    survives lost executors, and later plans know its size."""
    return stored_at(df, new_folder(df.sparkSession, label), **options)


def stored_at(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``df`` written as Parquet to ``path`` and read back."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
