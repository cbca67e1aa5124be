"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes as well as by rows, as texts have no bound of their own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; the path goes to Spark as it is, so any file system Spark knows will do."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); where it is unset, a temporary one in local mode,
    and an error on a cluster, whose executors do not see the driver's folders."""
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    bound_batches(spark)
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


_held: dict[Any, Any] = {}


def held(key: Any, make: Callable[[], Any]) -> Any:
    """make(), kept under key in a worker process until another key is asked for: workers outlive stages, and what one
    operator remembers must not take memory from the next one."""
    if key not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[key] = make()
    return _held[key]


def let(value: Column, body) -> Column:
    """body(value) with value computed once per row, however often body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, stored, with a broadcast hint where it has at most so many rows (of a bounded width); else joins shuffle."""
    kept = stored(df, "small")
    return F.broadcast(kept) if kept.limit(rows + 1).count() <= rows else kept
