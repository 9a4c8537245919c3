"""What a query really read, from the metrics of its tasks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """A reader whose bytes are counted: vectored reads run outside a task's own statistics."""
    return spark.read.option("parquet.hadoop.vectored.io.enabled", "false").parquet(path)


@dataclass(frozen=True)
class Read:
    result: object
    n_bytes: int
    n_rows: int
    milliseconds: float


def scanned(spark: SparkSession, run: Callable[[], object]) -> Read:
    """Run ``run`` and sum bytes and rows that all its tasks read from storage.

    Row groups and files that a scan skips are not read, so they do not count; no second scan is
    needed to model them. Tables should come from ``parquet`` above.
    """
    sc, tag = spark.sparkContext, f"read-{uuid.uuid4().hex}"
    core = sc._jsc.sc()
    sc.addJobTag(tag)
    start = time.perf_counter()
    try:
        result = run()
    finally:
        sc.removeJobTag(tag)
    spent = (time.perf_counter() - start) * 1000
    core.listenerBus().waitUntilEmpty()
    n_bytes = n_rows = 0
    for job in core.statusTracker().getJobIdsForTag(tag):
        info = sc.statusTracker().getJobInfo(job)
        for stage in info.stageIds if info else ():
            try:
                data = core.statusStore().lastStageAttempt(stage)
            except Py4JJavaError:  # a stage that was planned but never ran
                continue
            n_bytes += data.inputBytes()
            n_rows += data.inputRecords()
    return Read(result, n_bytes, n_rows, spent)
