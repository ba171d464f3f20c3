"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000

_SHIPPED: set[str] = set()
_REMEMBERED: list[dict] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one that ``spark.checkpoint.dir`` names.

    Where the setting is absent, as in a bare local session, it is set once for
    the session; a cluster always names its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="stormledger-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and read it back.

    This also cuts the lineage: a lost executor costs a file read, not a rerun.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make the session fit for Python over whole documents.

    Batches for Python get ``BATCH_ROWS`` rows at most, since a batch of long
    documents must fit a worker; and this package is sent to the executors, once
    per application.
    """
    sc = spark.sparkContext
    if int(spark.conf.get(BATCH)) > BATCH_ROWS:
        spark.conf.set(BATCH, BATCH_ROWS)
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="stormledger-code-"), "stormledger.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def remember(*memories: dict) -> None:
    """Say which memories this worker goes on with; those of other operators are emptied.

    Workers outlive the stages of an application, and what each stage remembers
    would add up.
    """
    for old in _REMEMBERED:
        if not any(old is memory for memory in memories):
            old.clear()
            pa.default_memory_pool().release_unused()
    _REMEMBERED[:] = memories


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def deals(rows: int, per_task: int) -> int:
    """Number of groups that hold about ``per_task`` rows each."""
    return max(1, -(-rows // per_task))


def crc32_mod(column: str, n: int) -> Column:
    """crc32 of a value written as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
